"""Token-ID files: whole texts encoded with a public tokenizer, compressed by the
adaptive range coder (``range_coder``), written in ascending doc_id order, read back.

A file is a sequence of sections (tag, length, body): ``G`` a group of ids that
decodes alone, ``D`` the ids and lengths of the documents that end within the
groups so far. Documents are ranged over files by doc_id and sorted inside a
file. A task writes one file under a name of its own; only files
named in the committed manifest count, so lost or repeated tasks leave no rows behind.

Encoding is done piece by piece where the tokenizer itself never looks across white space (its
splitter drops it and no other rule spans it; a file with another normaliser, splitter or model
is given whole texts). Words of plain letters, digits and signs are cut as the tokenizer's own splitter does,
many texts at a time, and a new piece goes straight to its model; other words, and any
that may hold a special token, go through the whole tokenizer. What is known costs a lookup.
"""

from __future__ import annotations

import io
import json
import re
import string
import struct
import sys
import types
import uuid
import zlib
from codecs import charmap_decode

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.common import id_text, qualified, scratch_uri, stored
from cartpulse.llm.files import open_input, open_output
from cartpulse.llm.range_coder import BLOCK, decode_group, encode_group

MAGIC = b"TOKIDS1\n"
SECTION, SECTION_BYTES = "<cQ", 9
VOCABULARY = "word_bpe_49k.json"
END_ID = 2
GROUP_IDS = 4096 * BLOCK
CACHE_PIECES = 600_000  # beyond it the cache starts anew with the next chunk
CHUNK_BYTES = 1 << 22  # texts cut and looked up at a time
PLAIN = re.compile(r"[!-;=?-~À-ÖØ-öø-ÿ]+")  # no "<" or ">": special tokens take the whole tokenizer
ODD_PIECE = re.compile(rb"[^!-&(-;=?-~\xC3\x80-\xBF]|\xC3[\x97\xB7]|(?<!\xC3)[\x80-\xBF]")
SPACES = " \t\n\v\f\r"
SPACE_BYTE = re.compile(rb"[\x20\x09-\x0D]")
SPACE, LETTER, DIGIT, MARK, ODD = range(5)
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _classes() -> np.ndarray:
    """Class of each byte. An apostrophe may begin a piece of letters, "<" a special token: odd, like all that is not ASCII."""
    out = np.full(256, ODD, np.uint8)
    out[0x21:0x7F] = MARK
    for chars, kind in ((SPACES, SPACE), (string.ascii_letters, LETTER), (string.digits, DIGIT), ("'<>", ODD)):
        out[list(chars.encode())] = kind
    return out


CLASS = _classes()
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def _byte_letters() -> str:
    """The byte-level alphabet, a character for each byte: printable bytes stand for themselves,
    the others, in order, for 256 and up."""
    out, spare = [], 256
    for b in range(256):
        own = 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF
        out.append(chr(b if own else spare))
        spare += not own
    return "".join(out)


BYTE_LETTERS = _byte_letters()


class PieceCache:
    """Pieces of words, as UTF-8, to their ids: all texts of a chunk are cut and looked up together.

    A byte table gives each byte its class; a piece starts where the class changes, and at every
    digit, as in the tokenizer's own splitter. A word with a byte of the class "odd" stays whole. The
    distinct pieces of a chunk are looked up once each; their ids lie in one pool, from which the chunk's ids are gathered.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self._clear()

    def _clear(self):
        self.at: dict[bytes, int] = {}
        self.first, self.count, self.n = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0
        self.pool, self.used = np.zeros(1 << 18, np.uint32), 0

    def _split(self, piece: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(charmap_decode(piece, "strict", BYTE_LETTERS)[0])]

    def _word(self, word: bytes) -> list[int]:
        text = word.decode("utf-8", "replace")
        if not PLAIN.fullmatch(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return [i for part in PIECES.findall(text.lower()) for i in self._split(part.encode())]

    def _learn(self, pieces: list[bytes], odd: bool):
        """New pieces go behind the known ones; ``odd``: whole words may be among them."""
        ids, ends = [], [0]
        for p in pieces:
            if not p.isspace():
                ids += self._word(p) if odd and ODD_PIECE.search(p) else self._split(p)
            ends.append(len(ids))
        first = np.array(ends, np.int64)
        count, first = np.diff(first), first[:-1]
        end, used = self.n + len(pieces), self.used + len(ids)
        for name, size in (("first", end), ("count", end), ("pool", used)):
            held = getattr(self, name)
            if size > len(held):
                setattr(self, name, np.concatenate([held, np.zeros(max(size, 2 * len(held)) - len(held), held.dtype)]))
        self.first[self.n:end], self.count[self.n:end] = self.used + first, count
        self.pool[self.used:used] = ids
        self.at.update(zip(pieces, range(self.n, end)))
        self.n, self.used = end, used

    def _chunk(self, texts: list[bytes]) -> list[np.ndarray]:
        raw = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
        kind, low = CLASS.take(raw), LOWER.take(raw)
        lead = np.flatnonzero(raw == 0xC3)  # letters of two bytes
        tail = raw[lead + 1]
        lead, tail = lead[(tail != 0x97) & (tail != 0xB7)], tail[(tail != 0x97) & (tail != 0xB7)]
        kind[lead] = kind[lead + 1] = LETTER
        low[lead + 1] = np.where(tail < 0x9F, tail + 0x20, tail)
        odd = np.flatnonzero(kind == ODD)
        if len(odd):
            edge = np.flatnonzero((kind[1:] == SPACE) != (kind[:-1] == SPACE)) + 1  # begin and end of each word in turn
            word = np.unique(np.searchsorted(edge, odd, "right") - 1)
            begin, size = edge[word], edge[word + 1] - edge[word]
            inside = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
            kind[inside], low[inside] = ODD, raw[inside]
        cut = np.empty(len(kind), bool)
        cut[0] = True
        np.not_equal(kind[1:], kind[:-1], out=cut[1:])
        cut |= kind == DIGIT
        start = np.flatnonzero(cut)
        offsets = np.append(start, len(raw)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(low)]).dictionary_encode()
        if self.n > CACHE_PIECES:
            self._clear()
        _, at, held = (x and memoryview(x) for x in pieces.dictionary.buffers())
        at, held = at.cast("i")[:len(pieces.dictionary) + 1].tolist(), bytes(held)
        distinct = [held[i:j] for i, j in zip(at, at[1:])]
        self._learn([p for p in distinct if p not in self.at], len(odd) > 0)
        piece = np.array([self.at[p] for p in distinct], np.int64).take(pieces.indices.to_numpy())
        count = self.count.take(piece)
        ends = np.cumsum(count)
        ids = self.pool.take(np.repeat(self.first.take(piece) - ends + count, count) + np.arange(ends[-1]))
        stops = np.cumsum([0] + [len(t) + 1 for t in texts])  # the line feed before each text, and after the last
        bounds = np.append(0, ends).take(np.searchsorted(start, stops))
        return [ids[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids of whole texts; None is empty. A chunk is cut at white space only."""
        parts, of = [], []
        for k, text in enumerate(texts):
            text, at = text or b"", 0
            while len(text) - at > CHUNK_BYTES and (space := SPACE_BYTE.search(text, at + CHUNK_BYTES)):
                parts.append(text[at:space.start()])
                of.append(k)
                at = space.start()
            parts.append(text[at:] if at else text)
            of.append(k)
        out, waiting, size = [], [], 0
        for part in parts:
            if waiting and size + len(part) > CHUNK_BYTES:
                out += self._chunk(waiting)
                waiting, size = [], 0
            waiting.append(part)
            size += len(part)
        if waiting:
            out += self._chunk(waiting)
        if len(parts) == len(texts):
            return out
        whole: list[list[np.ndarray]] = [[] for _ in texts]
        for k, ids in zip(of, out):
            whole[k].append(ids)
        return [np.concatenate(x) for x in whole]


#: The parts of a tokenizer file for which words may be encoded one by one.
WORD_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "truncation": None, "padding": None}
MODEL_RULES = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>",
               "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}


class WholeTexts:
    """Any other tokenizer: the library encodes each text whole."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        return [np.array(self.tokenizer.encode((t or b"").decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32) for t in texts]


def by_words(spec: dict) -> bool:
    """Whether a tokenizer file's rules are those that never look across white space."""
    model = {k: v for k, v in spec["model"].items() if k not in ("vocab", "merges")}
    plain = all("<" in t["content"] and not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) and not t["content"].split()[1:]
                for t in spec.get("added_tokens", []))
    return plain and model == MODEL_RULES and all(spec.get(k) == v for k, v in WORD_RULES.items())


def encoder(tokenizer_file: str | None = None) -> PieceCache | WholeTexts:
    """The worker's encoder for a tokenizer file; kept while the worker lives."""
    kept = sys.modules.setdefault("_token_caches", types.ModuleType("_token_caches")).__dict__
    if (tokenizer_file or "") not in kept:
        from tokenizers import Tokenizer
        if tokenizer_file is None:
            import public_tokenizers
        path = tokenizer_file or public_tokenizers.path(VOCABULARY)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kept[tokenizer_file or ""] = (PieceCache if by_words(spec) else WholeTexts)(Tokenizer.from_file(path))
    return kept[tokenizer_file or ""]


class TokenWriter:
    """Writes documents to one file; holds about a group of ids at a time."""

    def __init__(self, out, group_ids: int = GROUP_IDS):
        self.out, self.group_ids = out, group_ids
        self.waiting: list[np.ndarray] = []
        self.n_waiting, self.total, self.bytes = 0, 0, out.write(MAGIC)
        self.ids: list[int | None] = []
        self.lengths: list[int] = []

    def _section(self, tag: bytes, body: bytes):
        self.bytes += self.out.write(struct.pack(SECTION, tag, len(body))) + self.out.write(body)

    def add(self, doc_id: int | None, ids: np.ndarray):
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.total += len(ids)
        self.ids.append(doc_id)
        self.lengths.append(len(ids))
        if self.n_waiting >= self.group_ids:
            self._groups(self.n_waiting // self.group_ids * self.group_ids)

    def _groups(self, n: int):
        ids = np.concatenate(self.waiting)
        for at in range(0, n, self.group_ids):
            self._section(b"G", encode_group(ids[at:min(n, at + self.group_ids)]))
        left = ids[n:]
        self.waiting, self.n_waiting = [left], len(left)
        done = len(self.ids) - (1 if len(left) else 0)  # the last document may go on in the next group
        while done and self.lengths and sum(self.lengths[done:]) < len(left):
            done -= 1
        self._documents(done)

    def _documents(self, n: int):
        known = [0 if d is None else d for d in self.ids[:n]]
        body = struct.pack("<Q", n) + np.array(known, "<i8").tobytes() + np.array([d is None for d in self.ids[:n]], "u1").tobytes() + np.array(self.lengths[:n], "<u8").tobytes()
        self._section(b"D", zstandard.ZstdCompressor().compress(body))
        self.ids, self.lengths = self.ids[n:], self.lengths[n:]

    def close(self):
        if self.n_waiting:
            self._section(b"G", encode_group(np.concatenate(self.waiting)))
        self._documents(len(self.ids))
        self.out.close()


def read_documents(source):
    """``(doc_id, ids)`` of every document of a file, in order."""
    if source.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    held, n_held = [], 0
    while head := source.read(SECTION_BYTES):
        tag, size = struct.unpack(SECTION, head)
        body = source.read(size)
        if len(body) != size:
            raise ValueError("token file ends inside a section")
        if tag == b"G":
            held.append(decode_group(io.BytesIO(body)))
            n_held += len(held[-1])
            continue
        body = zstandard.ZstdDecompressor().decompress(body)
        n = struct.unpack("<Q", body[:8])[0]
        docs, none, lengths = np.frombuffer(body, "<i8", n, 8), np.frombuffer(body, "u1", n, 8 + 8 * n), np.frombuffer(body, "<u8", n, 8 + 9 * n)
        ids, at = np.concatenate(held) if held else np.zeros(0, np.uint32), 0
        for doc, missing, length in zip(docs.tolist(), none.tolist(), lengths.tolist()):
            yield None if missing else doc, ids[at:at + length]
            at += length
        held, n_held = [ids[at:]], n_held - at
    if n_held:
        raise ValueError("token file ends inside a document")


def write_tokens(docs: DataFrame, folder: str, tokenizer_file: str | None = None, end_id: int | None = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files below ``folder``; returns the manifest
    ``(path, first_id, n_docs, n_ids, bytes)``, stored."""
    folder = qualified(docs.sparkSession, folder)
    rows = id_text(docs, id_col, text_col).repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    end = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches):
        cache, writer, first, n = encoder(tokenizer_file), None, None, 0
        path = f"{folder}/{uuid.uuid4().hex}.tok"
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), cache.encode(b.column(1).cast(pa.binary()).to_pylist())):
                if writer is None:
                    writer, first = TokenWriter(open_output(path)), doc
                writer.add(doc, np.concatenate([ids, end]))
                n += 1
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([writer.total], pa.int64()),
                                              pa.array([writer.bytes], pa.int64())], ["path", "first_id", "n_docs", "n_ids", "bytes"])

    return stored(rows.mapInArrow(run, "path string, first_id long, n_docs long, n_ids long, bytes long"), "token-manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, from the files themselves.
    The manifest has one row per file; their totals place each file in the whole."""
    files = manifest.select("path", "first_id", "n_ids").collect()
    files.sort(key=lambda r: (r["first_id"] is not None, r["first_id"] or 0, r["path"]))
    rows, at = [], 0
    for r in files:
        rows.append((r["path"], at))
        at += r["n_ids"]

    def run(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out: list[tuple] = []
                with open_input(path) as source:
                    for doc, ids in read_documents(source):
                        out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = manifest.sparkSession.createDataFrame(rows, "path string, start long").repartition(max(1, len(rows)))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenize(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the documents as token files (below ``spark.checkpoint.dir`` unless ``folder``
    is given) and return what the files hold, one row per input row.

    A NULL or empty text has only the end id. Documents with a NULL id come first; rows
    that repeat an id follow each other. An empty table writes no file and gives no rows;
    extra columns are not read.
    """
    return read_tokens(write_tokens(docs, folder or scratch_uri(docs.sparkSession, "tokens"), **options))
