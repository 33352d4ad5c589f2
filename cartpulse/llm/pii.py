"""Personal data by a skip-chain conditional random field over the tokens of a document.

Known formats (``email``, ``ip``, ``card``, ``phone``) are found by pattern; they stay. The
field then looks for what the patterns miss or drop: a number run together
with its neighbour, a repeat of known data in another notation.

*Variables* are the tokens with a digit or ``@``; every other token is fixed to
"none", so the graph of a document without such tokens is empty. Labels: none
and the four kinds.
*Unary potentials* are a maximum-entropy model over shape features (digit count,
Luhn check, signs, dots, letters, the shape of the neighbours).
*Chain edges* join neighbouring variables, *skip edges* each token with the last
one of the same key or, where one of them lies in a known span, with that one: never
all pairs, and known data reaches each of its repeats over one edge. Keys are the address, numbers with
dots between (of any length), and the last ``SUFFIX`` digits up to a token's end, counted on into the number tokens right
before it. Numbers of one key are laid on each other from their ends as far as their digits
agree, and tokens are joined group by group: ``+49 30 901820`` meets ``030 901820``, one token meets all its groups.
Shorter numbers without dots have no key: seven digits are the least of a phone number.
An edge from known data weighs
``SAME`` for agreement, whatever the sample shows: a repeat of known data is of its kind throughout the document.
*Inference* is loopy sum-product message passing, all documents of a batch at
once (their graphs are disjoint blocks of one edge list), with damping, until no message changes.

Training is piecewise: unary weights by gradient steps on tokens of all documents labelled by the
patterns, at most ``SAMPLE_TOKENS / LABELS`` of each label (smallest hash of document, position and token
first; tokens inside a dropped match of several tokens are left out as unlabelled), chain and skip
potentials from the label agreement counts of the same sample. Where a label has more
tokens, the share taken is made up for in the constant weight and in the counts.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cartpulse.llm.common import id_text, stored

KINDS = ("email", "ip", "card", "phone")
LABELS = 5  # 0: none, then the kinds in order
# fixed values: formats of the contract. The look-behinds only spare starts inside a run that cannot match
EMAIL_AT = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])" + EMAIL_AT.pattern)
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
HAS_MARK = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
EDGES_OF_TOKEN = re.compile(r"^[^0-9A-Za-z+(]*(.*?)[^0-9A-Za-z)]*$", re.S)

SAMPLE_TOKENS, STEPS, DAMPING, TOLERANCE, SAME, LEAST = 40_000, 150, 0.3, 1e-6, 20.0, 0.9
FEATURES = 40
SUFFIX, SURE, REACH = 7, 9, 19  # digits of a key: the shortest number of a kind; of a known phone number; looked at before a token's end: the longest
DOTTED = re.compile(r"[0-9]++(?:\[?\.\]?[0-9]++)+")
NUMBER = re.compile(r"[0-9()+./-]+")
DIGITS_OF = {3: (13, 19), 4: (7, 15)}  # least and most digits of a card and a phone number


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str):
    at = 0
    while True:
        m = EMAIL_AT.match(text, at) if at else None  # a match may start right after the last one, inside a run
        m = m or EMAIL.search(text, at)
        if not m:
            return
        yield m
        at = m.end()


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(kind number, start, end) of the known formats by kind, then start; and the dropped matches."""
    out, dropped = [], []
    if "@" in text:
        out += [(0, m.start(), m.end()) for m in _emails(text)]
    if text.count(".") >= 3:
        for m in IP.finditer(text):
            ok = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))
            (out.append((1, m.start(), m.end())) if ok else dropped.append(m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m.group()) if m.end() - m.start() <= 37 else "0" * 20
            (out.append((2, m.start(), m.end())) if 13 <= len(digits) <= 19 and luhn(digits) else dropped.append(m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            n = len(NOT_DIGIT.sub("", m.group()))
            (out.append((3, m.start(), m.end())) if 9 <= n <= 15 else dropped.append(m.span()))
    return out, dropped


def variables(text: str) -> list[tuple[int, int, str]]:
    """(start, end, core) of the tokens with a digit or ``@``, stripped of surrounding marks."""
    out = []
    for m in TOKEN.finditer(text):
        core = EDGES_OF_TOKEN.match(m.group())
        if core and core.group(1):
            out.append((m.start() + core.start(1), m.start() + core.end(1), core.group(1)))
    return out


def _shape(core: str) -> tuple[int, list[int]]:
    """Number of digits and the numbers of the features that hold for one token."""
    digits = NOT_DIGIT.sub("", core)
    n, letters = len(digits), any(c.isalpha() for c in core)
    on = [0, 1 + min(n, 20)]
    at = core.find("@")
    on += [22] if at > 0 and "." in core[at:] else [23] if at >= 0 else []
    on += [24] if 13 <= n <= 19 and not letters and luhn(digits) else []
    on += [25] if core[0] == "+" else []
    on += [26] if "(" in core or ")" in core else []
    on += [27 + min(core.count("."), 4)]
    on += [32] if "-" in core else []
    on += [33] if letters else []
    parts = core.split(".")
    on += [34] if len(parts) == 4 and all(p.isdigit() and p.isascii() and len(p) <= 3 and int(p) <= 255 for p in parts) else []
    return n, on


def _overlaid(a: list[int], b: list[int], digits: list[str]):
    """Token pairs of two numbers, given as tokens from the last back, laid on each other from the end: those whose
    common digits are the whole of one of both, leading zeros apart. Where a token has digits before them,
    the other number must end there, or ``SURE`` digits agree."""
    left, right = ("".join(digits[i] for i in reversed(x)) for x in (a, b))
    same = next((k for k, (c, d) in enumerate(zip(reversed(left), reversed(right))) if c != d), min(len(left), len(right)))
    all_left, all_right = (same >= min(len(d.lstrip("0")), SURE) for d in (left, right))
    x = y = from_x = from_y = 0
    while x < len(a) and y < len(b) and max(from_x, from_y) < same:
        one, two = digits[a[x]], digits[b[y]]
        to_x, to_y = from_x + len(one), from_y + len(two)
        common = min(to_x, to_y, same) - max(from_x, from_y)
        own_x, own_y = len(one.lstrip("0")) or len(one), len(two.lstrip("0")) or len(two)
        if common >= min(own_x, own_y) and (all_right or from_x + own_x <= same) and (all_left or from_y + own_y <= same):
            yield a[x], b[y]
        if to_x <= to_y:
            x, from_x = x + 1, to_x
        if to_y <= to_x:
            y, from_y = y + 1, to_y


def graph(text: str, base=()):
    """Tokens, feature lists, chain pairs and skip pairs of one document; ``base`` holds its known spans."""
    tokens = variables(text)
    shapes = [_shape(t[2]) for t in tokens]
    known = token_labels(tokens, base, []) if base else [0] * len(tokens)
    chain, groups, digits, numbers, joins = [], {}, [], [], False
    for i, (s, _, core) in enumerate(tokens):
        n, on = shapes[i]
        near = i and s - tokens[i - 1][1] <= 2
        if near:
            chain.append((i - 1, i))
            on.append(35 if tokens[i - 1][2][0] == "+" else 36)
            shapes[i - 1][1].append(37 if n >= 7 else 38)
        digits.append(NOT_DIGIT.sub("", core))
        numbers.append([i])
        if "@" in core:
            mail, joins = EMAIL.search(core), False
            groups.setdefault((mail.group() if mail else core).lower(), []).append(i)
            continue
        plain = NUMBER.fullmatch(core) is not None
        if near and plain and joins:  # the tokens of the number before, as far as one may reach
            room = REACH - n
            for k in numbers[i - 1]:
                if room <= 0:
                    break
                numbers[i].append(k)
                room -= len(digits[k])
        joins = plain
        last = "".join(digits[k] for k in reversed(numbers[i]))[-SUFFIX:]
        if len(last) == SUFFIX:
            groups.setdefault(last, []).append(i)
        for m in DOTTED.finditer(core) if "." in core else ():
            groups.setdefault("." + ".".join(p.lstrip("0") or "0" for p in re.findall("[0-9]+", m.group())), []).append(i)
    skip = set()
    for key, group in groups.items():
        sure = next((i for i in group if known[i]), None)
        hub = group[0] if sure is None else sure
        for i in group:
            if i != hub:
                pairs = _overlaid(numbers[hub], numbers[i], digits) if key.isdigit() and len(key) == SUFFIX else [(hub, i)]
                skip.update((min(pair), max(pair)) for pair in pairs if pair[0] != pair[1])
            if sure is None or known[i] and i > sure:
                hub = i
    return tokens, [on for _, on in shapes], chain, sorted(skip, key=lambda pair: pair[::-1])


def token_labels(tokens, base, dropped) -> list[int]:
    """Label per token from the known spans that overlap it; -1 inside a dropped match
    of more than the token (a token dropped alone failed its own check: none)."""
    marks = sorted([(s, e, k + 1) for k, s, e in base] + [(s, e, -1) for s, e in dropped])
    out, first, reach = [0] * len(tokens), 0, max([e - s for s, e, _ in marks], default=0)
    for i, (s, e, _) in enumerate(tokens):
        while first < len(marks) and marks[first][0] < s - reach:
            first += 1
        k = first
        while k < len(marks) and marks[k][0] < e:
            if marks[k][1] > s and out[i] <= 0 and marks[k] != (s, e, -1):
                out[i] = marks[k][2]
            k += 1
    return out


def _dense(features: list[list[int]]) -> np.ndarray:
    x = np.zeros((len(features), FEATURES))
    for row, on in zip(x, features):
        row[on] = 1
    return x


def sample(docs: DataFrame, quota: int) -> tuple[list, np.ndarray]:
    """The ``quota`` labelled tokens of the smallest hashes for each label, from all of ``docs(doc_id, text)``,
    and per label how many tokens of the table one of them stands for. Tasks keep one more than
    ``quota`` a label, which shows that there are more."""

    def run(batches):
        kept: list[list] = [[] for _ in range(LABELS)]
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text or not HAS_MARK.search(text):
                    continue
                tokens, features, chain, skip = graph(text)
                labels = token_labels(tokens, *base_spans(text))
                before, alike = ({v: labels[u] for u, v in pairs} for pairs in (chain, skip))
                for i, on in enumerate(features):
                    if labels[i] >= 0:
                        digest = xxhash.xxh64_intdigest(f"{doc}:{i}:{tokens[i][2]}") >> 1
                        kept[labels[i]].append((digest, on, before.get(i, -1), alike.get(i, -1)))
                for rows in kept:
                    if len(rows) > 2 * quota:
                        rows.sort()
                        del rows[quota + 1:]
        rows = [(label, *r) for label, group in enumerate(kept) for r in sorted(group)[:quota + 1]]
        types = (pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], ["label", "digest", "features", "before", "alike"])

    # parts of the digests a sixteenth of a power of two wide: few, and few tokens beyond the quota in the last one
    tokens = stored(docs.mapInArrow(run, "label int, digest long, features array<int>, before int, alike int"), "pii-sample")
    tokens = tokens.withColumn("part", F.floor(F.log2(F.col("digest") + F.lit(1.0)) * 16))
    ends, held = {}, [0] * LABELS
    for r in sorted(tokens.groupBy("label", "part").count().collect()):
        if held[r["label"]] < quota:
            ends[r["label"]] = r["part"]
        held[r["label"]] += r["count"]
    rows, stands = [], np.ones(LABELS)
    wanted = F.lit(False)
    for label, part in ends.items():
        wanted = wanted | ((F.col("label") == label) & (F.col("part") <= part))
    found = sorted(tokens.filter(wanted).drop("part").collect()) if ends else []
    for label in ends:
        of = [r for r in found if r["label"] == label][:quota]
        rows += of
        if held[label] > quota:
            stands[label] = 2.0 ** 63 / (of[-1]["digest"] + 1)
    return rows, stands


def train(docs: DataFrame, sample_tokens: int = SAMPLE_TOKENS) -> dict | None:
    """Weights from at most ``sample_tokens`` tokens of all of ``docs(doc_id, text)``, an equal
    quota a label. None where no document has a known span."""
    rows, stands = sample(docs, max(1, sample_tokens // LABELS))
    if not any(r["label"] for r in rows):
        return None
    x, y = _dense([r["features"] for r in rows]), np.eye(LABELS)[[r["label"] for r in rows]]
    weights, speed = np.zeros((FEATURES, LABELS)), np.zeros((FEATURES, LABELS))
    for _ in range(STEPS):  # gradient ascent with momentum on the penalised mean log-likelihood
        scores = x @ weights
        scores -= scores.max(axis=1, keepdims=True)
        odds = np.exp(scores)
        speed = 0.9 * speed + x.T @ (y - odds / odds.sum(axis=1, keepdims=True)) / len(rows) - 1e-4 * weights
        weights += speed
    weights[0] += np.log(stands)  # the quotas change how frequent the labels are, not what tokens of one look like
    share = stands[[r["label"] for r in rows]]
    share *= len(rows) / share.sum()

    def agreement(column):
        both = np.ones((LABELS, LABELS))
        for r, counts in zip(rows, share):
            if r[column] >= 0:
                both[r[column], r["label"]] += counts
        both /= both.sum()
        return np.log(both / (both.sum(axis=1, keepdims=True) * both.sum(axis=0, keepdims=True)))

    alike = agreement("alike")
    return {"unary": weights.round(6), "chain": agreement("before").round(6), "skip": ((alike + alike.T) / 2).round(6)}


def marginals(unary: np.ndarray, edges: np.ndarray, potentials: np.ndarray, sweeps: int | None = None, reach: int | None = None) -> np.ndarray:
    """Loopy sum-product: (tokens, labels) log potentials, (edges, 2) token pairs and their
    (edges, labels, labels) log potentials in; marginal probabilities out. Exact on trees.

    Messages pass until none changes by ``TOLERANCE`` (or, if given, for ``sweeps``); an edge rests while nothing
    changes at its ends. After more than twice ``reach`` sweeps (tokens of the largest graph: all
    evidence has crossed it, damped) the steps shrink, so loops whose messages swing come to rest too."""
    u, v = edges[:, 0], edges[:, 1]
    to_v, to_u = np.zeros((len(edges), LABELS)), np.zeros((len(edges), LABELS))
    belief, live, step, done = unary.copy(), np.arange(len(edges)), 1 - DAMPING, 0

    def passed(scores, axis):
        new = scores.max(axis=axis)
        new += np.log(np.exp(scores - np.expand_dims(new, axis)).sum(axis=axis))
        return new - new.max(axis=1, keepdims=True)

    while len(live) and (sweeps is None or done < sweeps):
        a, b, pair = u[live], v[live], potentials[live]
        by_v = step * (passed((belief[a] - to_u[live])[:, :, None] + pair, 1) - to_v[live])
        by_u = step * (passed((belief[b] - to_v[live])[:, None, :] + pair, 2) - to_u[live])
        to_v[live] += by_v
        to_u[live] += by_u
        for label in range(LABELS):
            belief[:, label] += np.bincount(b, by_v[:, label], len(unary)) + np.bincount(a, by_u[:, label], len(unary))
        done += 1
        if sweeps is None:
            moved = np.zeros(len(unary), bool)
            moved[b[np.abs(by_v).max(axis=1) > TOLERANCE]] = True
            moved[a[np.abs(by_u).max(axis=1) > TOLERANCE]] = True
            live = np.flatnonzero(moved[u] | moved[v])
            step *= 0.9 if done > 100 + 2 * (len(unary) if reach is None else reach) else 1
    out = np.exp(belief - belief.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def _added(text: str, kind: int, spans: list[tuple[int, int, bool]]):
    """The spans of one kind that the shape of its data allows, of neighbouring tokens given as (start, end, repeat of
    known data): all as one, or, where that has too many digits, the repeats in spans of as many as a number may have."""
    sizes = [len(NOT_DIGIT.sub("", text[s:e])) for s, e, _ in spans]
    if kind < 2:
        return [(kind, s, e) for (s, e, _), n in zip(spans, sizes) if ("@" in text[s + 1:e - 1] if kind == 0 else text.count(".", s, e) == 3 and n >= 4)]
    least, most = DIGITS_OF[kind + 1]
    if sum(sizes) <= most:
        return [(kind, spans[0][0], spans[-1][1])] if sum(sizes) >= least else []
    out, room = [], 0
    for (s, e, repeat), n in zip(spans, sizes):
        if not repeat or n > most:
            room = 0
        elif n > room:
            out.append((kind, s, e))
            room = most - n
        else:
            out[-1] = (kind, out[-1][1], e)
            room -= n
    return out


def find_spans(texts: list[str], model: dict | None) -> list[tuple[list, list]]:
    """Per text: known spans and added spans, as (kind number, start, end) by kind, then start.

    A span is added where the field gives tokens outside all known spans one kind
    with probability ``LEAST`` or more; neighbouring tokens of a phone number join, those of a
    card number where they repeat known data."""
    found, graphs = [], []
    for text in texts:
        if not HAS_MARK.search(text):
            found.append(([], []))
            continue
        base = base_spans(text)[0]
        found.append((base, []))
        if model is None:
            continue
        tokens, features, chain, skip = graph(text, base)
        inside = token_labels(tokens, base, [])
        if not all(inside):
            graphs.append((len(found) - 1, tokens, features, chain, skip, inside))
    if not graphs:
        return found
    edges, kinds, at = [], [], 0
    for _, tokens, _, chain, skip, inside in graphs:
        edges += [(at + a, at + b) for a, b in chain] + [(at + a, at + b) for a, b in skip]
        kinds += [0] * len(chain) + [2 if inside[a] or inside[b] else 1 for a, b in skip]
        at += len(tokens)
    weights = model["unary"]
    unary = np.array([weights[on].sum(axis=0) for g in graphs for on in g[2]])
    known = np.array([x for g in graphs for x in g[5]])
    sure = 30.0 + SAME * len(edges)  # tokens of known spans are observed: no number of messages outweighs them
    unary[known > 0] = -sure
    unary[known > 0, known[known > 0]] = sure
    potentials = np.stack([model["chain"], model["skip"], SAME * np.eye(LABELS)])[np.array(kinds, np.int64)]
    p = marginals(unary, np.array(edges, np.int64).reshape(-1, 2), potentials, reach=max(len(g[1]) for g in graphs))
    at = 0
    for where, tokens, _, chain, skip, inside in graphs:
        near, added = {b for _, b in chain}, []
        repeats = {x for a, b in skip for x, y in ((a, b), (b, a)) if inside[y]}
        for i, (s, e, _) in enumerate(tokens):
            label = int(p[at + i].argmax())
            if label and not inside[i] and p[at + i, label] >= LEAST:
                joins = label == 4 or label == 3 and i in repeats and i - 1 in repeats
                if joins and i in near and added and added[-1][2] == i - 1 and added[-1][0] == label - 1:
                    added[-1][1].append((s, e, i in repeats))
                    added[-1][2] = i
                else:
                    added.append([label - 1, [(s, e, i in repeats)], i])
        at += len(tokens)
        found[where][1].extend(sorted(span for k, spans, _ in added for span in _added(texts[where], k, spans)))
    return found


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def redacted(text: str, spans) -> str:
    """The text with each span replaced by ``[KIND]``; overlapping spans are one, under the first's kind."""
    out, at, end = [], 0, 0
    for s, e, k in sorted((s, e, k) for k, s, e in spans):
        if s >= end:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        end = max(end, e)
        at = end
    return "".join([*out, text[at:]])


BLOCK = 256  # texts whose graphs are handled at once


def tag(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, text, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` per
    input row: ``row`` packs the input columns, ``text`` is redacted, counts are those of known
    spans. Positions count code points, end exclusive. A NULL text counts as empty and
    stays NULL. Repeated rows are handled one by one; an empty table gives no rows."""
    base = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = train(id_text(docs, id_col, text_col))

    def run(batches):
        for b in batches:
            raw, cols = b.column(2).to_pylist(), [[] for _ in range(8)]
            for at in range(0, len(raw), BLOCK):
                texts = [t or "" for t in raw[at:at + BLOCK]]
                for t, source, (known, added) in zip(texts, raw[at:at + BLOCK], find_spans(texts, model)):
                    kinds = [k for k, _, _ in known]
                    values = (redacted(t, known + added) if source is not None else None, *(kinds.count(k) for k in range(4)),
                              hashlib.sha256(joined(known).encode()).hexdigest(), joined(sorted(known + added)), len(added))
                    for col, v in zip(cols, values):
                        col.append(v)
            types = (pa.string(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip(cols, types))],
                                             ["row", "doc_id", "text", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    # a type object, not its text: column names may hold any sign
    longs = [StructField(c, LongType()) for c in ("n_email", "n_ip", "n_card", "n_phone")]
    texts = [StructField(c, StringType()) for c in ("base_sha256", "spans")]
    return base.mapInArrow(run, StructType([base.schema["row"], base.schema["doc_id"], base.schema["text"], *longs, *texts, StructField("n_added", LongType())]))


def pii_report(docs: DataFrame, **options) -> DataFrame:
    """Counts and spans per input row, without the texts."""
    return tag(docs.select(*{options.get("id_col", "doc_id"), options.get("text_col", "text")}), **options).drop("row", "text")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows with personal data replaced, columns as they came; ``length_col``, if
    given, is set to the new text's length."""
    out = tag(docs, id_col, text_col)
    return out.select([F.col("text").alias(c) if c == text_col else
                       F.length("text").cast(docs.schema[c].dataType).alias(c) if c == length_col else
                       F.col("row").getField(c).alias(c) for c in docs.columns])
