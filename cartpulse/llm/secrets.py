"""Secret scan: known formats plus sliding-window entropy over candidate strings.

Known formats (``assign``, ``access``, ``hex``) are found by pattern. The entropy
scan takes every long run of key characters, splits it per character class
(hexadecimal, base 64) and slides a fixed window over it. Character counts are
updated by the one character that enters and the one that leaves, and with
them the running sum of c*log2(c), so a window costs two updates whatever its
length. Windows whose Shannon entropy reaches the class's threshold and that mix
letters and digits are flagged; overlapping ones become one ``entropy`` span.

An allow list suppresses runs that are random-looking by design (UUIDs, digests
named as such, documented example keys, the host and path of a link). A link's user part and what follows its
``?`` or ``#`` are scanned: keys travel there. The list never suppresses a known format.
A text is handled inside its row, in time linear in its length.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from cartpulse.llm.common import id_text

KINDS = ("assign", "access", "hex", "entropy")
# fixed values: formats of the contract; letters of the key names in either case
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}+")
# character class: pattern of its runs, window length, least entropy in bits
CLASSES = {"hex": (re.compile(r"[0-9A-Fa-f]{24,}+"), 24, 3.0), "base64": (re.compile(r"[A-Za-z0-9+/=_-]{20,}+"), 20, 3.85)}
# fixed values: runs that look random and are no secrets, matched against the whole run or the text before it
ALLOWED_RUN = re.compile(r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|.*example.*|(.)\2{19,}|[a-z_-]+|[0-9+/=_-]+")
NAMED = ("sha1", "sha-1", "sha256", "sha-256", "sha512", "sha-512", "md5", "commit", "checksum", "integrity", "etag")
BETWEEN = " :=\"'-"  # between such a name and the run
LINK_END, PATH_END, AUTHORITY_END = re.compile(r"[\s\"'<>]"), re.compile("[?#]"), re.compile("[/?#]")


def flagged_windows(run: str, window: int, least: float) -> list[tuple[int, int]]:
    """Merged [start, end) ranges of ``run`` whose windows reach ``least`` bits and hold letters and digits."""
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, letters, digits, out = 0.0, 0, 0, []
    limit = (math.log2(window) - least) * window + 1e-9  # entropy >= least exactly when the sum of c*log2(c) <= limit
    for i, ch in enumerate(run):
        if i >= window:
            old = run[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += term[c - 1] - term[c]
            letters -= old.isalpha()
            digits -= old.isdigit()
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += term[c + 1] - term[c]
        letters += ch.isalpha()
        digits += ch.isdigit()
        if i >= window - 1 and total <= limit and letters and digits:
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def link_paths(text: str) -> list[tuple[int, int]]:
    """[start, end) of the host and path of every link, from its ``://`` or its user part on, in order."""
    out, at = [], text.find("://")
    while at >= 0:
        start = at + 3
        m = LINK_END.search(text, start)
        end = m.start() if m else len(text)
        m = AUTHORITY_END.search(text, start, end)
        user = text.rfind("@", start, m.start() if m else end)
        m = PATH_END.search(text, start, end)
        out.append((user + 1 if user >= 0 else at, m.start() if m else end))
        at = text.find("://", end)
    return out


def named(text: str, start: int) -> bool:
    """Whether the run at ``start`` is named as a digest by the word before it."""
    while start and text[start - 1] in BETWEEN:
        start -= 1
    return text[max(0, start - 9):start].lower().endswith(NAMED)


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """[start, end) of high-entropy stretches outside the allow list, merged over the classes."""
    found, links, link = [], link_paths(text), 0
    for m in CANDIDATE.finditer(text):
        run = m.group()
        while link < len(links) and links[link][1] <= m.start():
            link += 1
        if link < len(links) and links[link][0] <= m.start() or ALLOWED_RUN.fullmatch(run) or named(text, m.start()):
            continue
        for pattern, window, least in CLASSES.values():
            for part in pattern.finditer(run):
                at = m.start() + part.start()
                found += [(at + s, at + e) for s, e in flagged_windows(part.group(), window, least)]
    out: list[tuple[int, int]] = []
    for s, e in sorted(found):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the known formats, leftmost and non-overlapping per kind."""
    out = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    return sorted(out)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy)`` per input row.

    Positions count code points, end exclusive; spans are ordered by start, then
    kind. A NULL text counts as empty and has none. Repeated rows are scanned one by one, an
    empty table gives no rows, other columns are not read.
    """

    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for text in b.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                kinds = [k for _, k, _ in base]
                extra = [(s, 3, e) for s, e in entropy_spans(text)]
                for col, v in zip(cols, (kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(joined(base).encode()).hexdigest(),
                                         joined(sorted(base + extra)), len(extra))):
                    col.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"])

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long")
