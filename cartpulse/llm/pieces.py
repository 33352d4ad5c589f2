"""SentencePiece encoding and decoding of whole texts, for merge-type (BPE) vocabularies.

A text is a row of symbols, one a character. The *agenda* holds every adjacent
pair whose joint string is a piece, ordered by the piece's score (the leftmost of
equals first). The best pair is taken off and merged, the two pairs it touches
are scored anew, until none is left; symbols that are no piece become bytes.

Merges never pass a pair of characters that stands in no piece. No piece of the
vocabulary has a space mark after another character, so each word with
the marks before it is encoded by itself, once while it is cached; line ends,
which join to nothing, stand alone. New words of a
batch run together: the agenda is an array, a column per word, and each step
takes the best pair of every column. Words over ``LANE`` characters
are cut where no piece joins two neighbours; parts still longer use a heap.

Every word that enters the cache is checked in its Arrow batch against the
sentencepiece library (``check="words"``); ``"texts"`` checks every whole text
(about as costly as all the rest together), ``None`` nothing. A difference raises ValueError.
Decoding is the library's.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import re
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.common import id_text

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
LANE = 32              # longest word, in characters, that runs in a column
COLUMNS = 8192         # columns of one run
CACHE_WORDS = 250_000  # words of one generation (or those of one part, if more); the one before is kept beside it
PART_BYTES = 8 << 20   # texts handled at a time
PAD = 0x110000         # stands for "no character"
FREE = np.int32(2**31 - 1)
LINE = "\n"
WORDS = re.compile(f"{SPACE}+[^{SPACE}{LINE}]*|{LINE}|[^{SPACE}{LINE}]+")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format


class Encoder:
    """Vocabulary, pair table and word cache of one model file.

    Raises ValueError for models of another kind: not BPE, without byte
    fallback, with user-defined or unused pieces, or with suffix space marks.
    """

    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        kinds = {p.type for p in model.pieces}
        if model.trainer_spec.model_type != pb.TrainerSpec.BPE or not model.trainer_spec.byte_fallback or kinds & {USER, UNUSED} \
                or model.trainer_spec.treat_whitespace_as_suffix or not model.normalizer_spec.escape_whitespaces:
            raise ValueError("a merge-type (BPE) model with byte fallback, prefix space marks and no user-defined or unused pieces is needed")
        norm = model.normalizer_spec
        self.plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.bos, self.eos = self.library.bos_id(), self.library.eos_id()
        pieces = {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.pairs = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}  # neighbours that some piece joins
        self.by_word = not any(p[1] == SPACE and p[0] != SPACE or LINE in p for p in self.pairs)
        symbols = {s: k for k, s in enumerate(sorted(set(pieces) | {c for p in pieces for c in p}))}
        n = self.none = len(symbols)  # the symbol that joins nothing
        self.ids = np.array([pieces[s][0] if s in pieces else -1 for s in symbols] + [-1], np.int64)
        ranks = dict(zip(pieces, np.unique([-s for _, s in pieces.values()], return_inverse=True)[1].tolist()))
        joins = {(symbols[p[:i]], symbols[p[i:]]): (symbols[p], ranks[p]) for p in pieces for i in range(1, len(p)) if p[:i] in symbols and p[i:] in symbols}
        if len(ranks) >= 1 << 25:
            raise ValueError("too many scores")
        self.joins = joins
        self._hash([a * (n + 1) + b for a, b in joins], list(joins.values()))
        self.symbols = symbols
        self.char = np.full(PAD + 1, n, np.int32)
        for s, k in symbols.items():
            if len(s) == 1:
                self.char[ord(s)] = k
        self.bytes = np.array([self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.uint32)
        self.words: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _hash(self, keys: list[int], joins: list[tuple[int, int]]):
        """Open-addressing table of the pairs, a quarter full at most."""
        bits = max(8, (4 * len(keys)).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), 1 << bits
        self.keys, self.merged, self.rank = np.full(self.slots, -1, np.int64), np.zeros(self.slots, np.int32), np.zeros(self.slots, np.int32)
        left, values = np.array(keys, np.int64), np.array(joins, np.int32).reshape(-1, 2)
        slot = self._slot(left)
        while len(left):
            free = self.keys[slot] < 0
            first = np.unique(slot[free], return_index=True)[1]
            put = np.flatnonzero(free)[first]
            self.keys[slot[put]] = left[put]
            self.merged[slot[put]], self.rank[slot[put]] = values[put].T
            rest = np.setdiff1d(np.arange(len(left)), put)
            left, values, slot = left[rest], values[rest], (slot[rest] + 1) & (self.slots - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _score(self, a: np.ndarray, b: np.ndarray, at: np.ndarray):
        """Agenda entry (rank and place in one number; FREE if the two join to nothing) and joint symbol of pairs."""
        shape = np.broadcast_shapes(a.shape, b.shape, at.shape)
        key = (a.astype(np.int64) * (self.none + 1) + b).reshape(-1)
        slot = self._slot(key)
        there = self.keys[slot]
        go = np.flatnonzero((there != key) & (there >= 0))
        while len(go):  # taken by another pair: the next slot
            slot[go] = (slot[go] + 1) & (self.slots - 1)
            there[go] = now = self.keys[slot[go]]
            go = go[(now != key[go]) & (now >= 0)]
        entry = np.where(there == key, self.rank[slot], FREE >> 6) << 6 | np.broadcast_to(at, shape).reshape(-1)
        return np.where(there == key, entry, FREE).astype(np.int32).reshape(shape), self.merged[slot].reshape(shape)

    def columns(self, words: list[str]) -> list[bytes]:
        """Ids, as little-endian 32-bit bytes, of words of at most LANE characters (as normalised)."""
        n, lens = len(words), np.fromiter(map(len, words), np.int64, len(words))
        width = int(lens.max())
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
        codes = np.full((width + 1, n), PAD, np.uint32)  # the last row stands before the first and behind the last
        codes[place, np.repeat(np.arange(n), lens)] = flat
        alive, sym = codes != PAD, self.char[codes]
        rows = np.arange(width + 1, dtype=np.int32)[:, None]
        after = np.where(rows + 1 < lens, rows + 1, width).astype(np.int32)
        ahead = np.where(rows > 0, rows - 1, width).astype(np.int32) + np.zeros((1, n), np.int32)
        agenda, joint = np.full((width + 1, n), FREE, np.int32), np.zeros((width + 1, n), np.int32)
        if width > 1:
            agenda[:-1], joint[:-1] = self._score(sym[:-1], sym[1:], rows[:-1])
        alive_, sym_, after_, ahead_, agenda_, joint_ = (x.reshape(-1) for x in (alive, sym, after, ahead, agenda, joint))
        while True:
            best = agenda.min(axis=0)
            col = np.flatnonzero(best != FREE)
            if not len(col):
                break
            at = best[col] & 63
            here, gone = at * n + col, after_[at * n + col] * n + col
            sym_[here], alive_[gone], agenda_[gone] = joint_[here], False, FREE
            right = after_[gone]
            after_[here], ahead_[right * n + col] = right, at
            agenda_[here], joint_[here] = self._score(sym_[here], sym_[right * n + col], at)
            left = ahead_[here]
            agenda_[left * n + col], joint_[left * n + col] = self._score(sym_[left * n + col], sym_[here], left)
        col, at = np.nonzero(alive.T)
        ids, code = self.ids[sym[at, col]], codes[at, col]
        size = np.where(ids >= 0, 1, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        out = np.repeat(ids, size).astype(np.uint32)
        if (ids < 0).any():
            raw = "".join(map(chr, code[ids < 0].tolist())).encode("utf-8", "surrogatepass")
            out[np.repeat(ids < 0, size)] = self.bytes[np.frombuffer(raw, np.uint8)]
        ends = (4 * np.cumsum(np.bincount(col, size, n))).astype(np.int64).tolist()
        blob = out.astype("<u4").tobytes()
        return [blob[s:e] for s, e in zip([0, *ends], ends)]

    def heap(self, part: str) -> bytes:
        """The same for a part of any length, one heap of pairs."""
        sym = [self.symbols.get(c, -1) for c in part]
        after, ahead = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        agenda: list[tuple] = []

        def enter(left: int, right: int):
            if left >= 0 and right < len(sym) and (found := self.joins.get((sym[left], sym[right]))):
                heapq.heappush(agenda, (found[1], left, right, sym[left], sym[right], found[0]))

        for i in range(len(sym) - 1):
            enter(i, i + 1)
        while agenda:
            _, left, right, a, b, joint = heapq.heappop(agenda)
            if sym[left] != a or sym[right] != b or after[left] != right:
                continue  # one side has been merged since
            sym[left], sym[right] = joint, None
            after[left] = after[right]
            if after[left] < len(sym):
                ahead[after[left]] = left
            enter(ahead[left], left)
            enter(left, after[left])
        out: list[int] = []
        for c, s in zip(part, sym):
            if s is not None:
                known = -1 if s < 0 else int(self.ids[s])
                out.extend([known] if known >= 0 else self.bytes[np.frombuffer(c.encode("utf-8", "surrogatepass"), np.uint8)].tolist())
        return np.array(out, "<u4").tobytes()

    def _parts(self, word: str) -> list[str]:
        cuts = [0, *(i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.pairs), len(word)]
        return [word[a:b] for a, b in itertools.pairwise(cuts)]

    def learn(self, words: list[str], check: bool) -> dict[str, bytes]:
        """Normalised words with their ids."""
        words = sorted(filter(None, words), key=len)  # columns of like height
        n = bisect.bisect_right(words, LANE, key=len)
        short, jobs = words[:n], {w: self._parts(w) for w in words[n:]}
        more = {p for parts in jobs.values() for p in parts}
        done = {"": b""} | {p: self.heap(p) for p in more if len(p) > LANE}
        for some in (sorted((p for p in more if len(p) <= LANE), key=len), short):
            for i in range(0, len(some), COLUMNS):
                done.update(zip(some[i:i + COLUMNS], self.columns(some[i:i + COLUMNS])))
        for w, parts in jobs.items():
            done[w] = b"".join([done[p] for p in parts])
        if check and self.by_word and self.plain:
            # the dummy prefix is the word's first space mark; other words follow a line end
            theirs = self.library.encode([w[1:] if w[0] == SPACE else LINE + w for w in words], num_threads=1)
            line = b"".join((self.columns([SPACE])[0], self.columns([LINE])[0]))
            ours = [done[w] if w[0] == SPACE and len(w) > 1 else line + done[w] if w[0] != SPACE else b"" for w in words]
            theirs = [t if o else [] for t, o in zip(theirs, ours)]  # (a space mark alone cannot be asked for)
            sizes = list(map(len, theirs))
            if [len(o) // 4 for o in ours] != sizes or b"".join(ours) != np.fromiter(itertools.chain.from_iterable(theirs), "<u4", sum(sizes)).tobytes():
                raise ValueError("encoding differs from the sentencepiece library")
        return done

    def cut(self, text: str) -> list[str]:
        """The normalised text's words, each with the space marks before it."""
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE) if self.plain else self.library.normalize(text)
        return WORDS.findall(text) if self.by_word else [text]

    def _words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All words of the texts, as normalised, and where each text's words end."""
        if self.plain and self.by_word:
            # nothing but single spaces between words: cut at them, all texts at once ("" between two line ends is a word without ids)
            odd = pc.or_(pc.match_substring_regex(texts, f"  |\\A | \\z|{SPACE}"), pc.equal(texts, ""))
            if not pc.any(odd).as_py():
                marked = pc.replace_substring(pc.replace_substring(texts, " ", f" {SPACE}"), LINE, f" {LINE} ")
                lists = pc.split_pattern(pc.binary_join_element_wise(SPACE, marked, ""), " ")
                return lists.flatten(), lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
            odd = odd.to_pylist()
            parts, last = [], 0
            sizes: list[int] = []
            for flag, run in itertools.groupby(range(len(texts)), odd.__getitem__):
                first, *rest = run
                last = rest[-1] if rest else first
                if flag:
                    cut = [self.cut(t) for t in texts[first:last + 1].to_pylist()]
                    parts.append(pa.array(list(itertools.chain.from_iterable(cut)), pa.string()))
                    sizes.extend(map(len, cut))
                else:
                    words, ends = self._words(texts[first:last + 1])
                    parts.append(words)
                    sizes.extend(np.diff(ends, prepend=0).tolist())
            return pa.concat_arrays(parts), np.cumsum(sizes)
        cut = [self.cut(t) for t in texts.to_pylist()]
        return pa.array(list(itertools.chain.from_iterable(cut)), pa.string()), np.cumsum([len(c) for c in cut], dtype=np.int64)

    def encode(self, texts: pa.Array, check: str | None = None) -> list[bytes]:
        """Ids of whole texts with begin and end ids, as little-endian 32-bit bytes."""
        texts = pc.fill_null(texts, "")
        words, ends = self._words(texts)
        coded = words.dictionary_encode()
        seen = coded.dictionary.to_pylist()
        new = [w for w in seen if w not in self.words]
        if len(self.words) + len(new) > CACHE_WORDS:  # a new generation begins with this part's words
            self.words, self.before = {w: self.words[w] for w in seen if w in self.words}, self.words
        known = {w: self.before[w] for w in new if w in self.before}
        self.words.update(known)
        self.words.update(self.learn([w for w in new if w not in known], check == "words"))
        packed = pa.array([self.words[w] for w in seen], pa.large_binary()).take(coded.indices)
        bounds = np.frombuffer(packed.buffers()[1], np.int64, len(packed) + 1, 8 * packed.offset) if len(packed) else np.zeros(1, np.int64)
        blob, ends = memoryview(packed.buffers()[2] or b""), bounds[np.asarray(ends, np.int64)].tolist()
        head, tail = (np.array([i], "<u4").tobytes() if i >= 0 else b"" for i in (self.bos, self.eos))
        out = [b"".join((head, blob[s:e], tail)) for s, e in zip([int(bounds[0]), *ends], ends)]
        if check == "texts":
            for mine, ids in zip(out, self.library.encode(texts.to_pylist(), num_threads=1, add_bos=self.bos >= 0, add_eos=self.eos >= 0)):
                if mine != np.array(ids, "<u4").tobytes():
                    raise ValueError("encoding differs from the sentencepiece library")
        return out


def encoder(model_file: str | None = None) -> Encoder:
    """The worker's encoder of a model file; kept while the worker lives."""
    kept = sys.modules.setdefault("_piece_encoders", types.ModuleType("_piece_encoders")).__dict__
    if (model_file or "") not in kept:
        if model_file is None:
            import public_tokenizers
        kept[model_file or ""] = Encoder(model_file or public_tokenizers.path(VOCABULARY))
    return kept[model_file or ""]


def _some(texts: pa.Array):
    """Ranges of texts of about PART_BYTES bytes."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + PART_BYTES, "right")))
        yield start, end
        start = end


def encode_pieces(docs: DataFrame, model_file: str | None = None, check: str | None = "words", decode: bool = False,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, decoded)`` per input row: the ids with begin and end ids, packed as
    little-endian 32-bit numbers (:func:`unpacked` gives an array), and, with ``decode``, what
    the library's ``decode(ids)`` makes of them (else NULL).

    A NULL or empty text has the begin and end ids only. Repeated rows and NULL
    ids stay as they are; an empty table gives no rows; other columns are not
    read, whatever their names. A very long text is held once by its task. No shuffle.
    """
    if check not in (None, "words", "texts"):
        raise ValueError("check must be None, 'words' or 'texts'")

    def run(batches):
        enc = encoder(model_file)
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for s, e in _some(texts):
                packed = enc.encode(texts.slice(s, e - s), check)
                back = enc.library.decode([np.frombuffer(p, "<u4").tolist() for p in packed], num_threads=1) if decode else [None] * len(packed)
                yield pa.RecordBatch.from_arrays([ids.slice(s, e - s), pa.array(packed, pa.binary()), pa.array(back, pa.string())], ["doc_id", "ids", "decoded"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary, decoded string")


def decode_pieces(encoded: DataFrame, model_file: str | None = None, ids_col: str = "ids") -> DataFrame:
    """All columns of ``encoded`` and ``decoded``, the library's text of the packed ids (NULL ids: NULL).
    A column that is named ``decoded`` already is replaced."""
    from pyspark.sql.types import StringType, StructField, StructType

    rows = encoded.drop("decoded") if ids_col != "decoded" else encoded.withColumnRenamed("decoded", "ids")
    at = "ids" if ids_col == "decoded" else ids_col
    place = rows.columns.index(at)

    def run(batches):
        enc = encoder(model_file)
        for b in batches:
            back = [None if p is None else enc.library.decode(np.frombuffer(p, "<u4").tolist()) for p in b.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(back, pa.string())], [*b.schema.names, "decoded"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("decoded", StringType())]))


def unpacked(ids) -> F.Column:
    """The packed ids as an array of longs."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    digit = lambda i, k: F.conv(F.hex(F.substring(ids, 4 * i + k, 1)), 16, 10).cast("long")
    n = F.octet_length(ids) / 4
    return F.when(n >= 1, F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: digit(i, 1) + digit(i, 2) * 256 + digit(i, 3) * 65536 + digit(i, 4) * 16777216)) \
        .otherwise(F.array().cast("array<bigint>"))
