"""Secrets, decontamination, personal data, quality, URLs and the pipeline: brute force, oracles, fixtures."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from cartpulse.llm import decontaminate, pii, quality_rules, secrets, simhash, url_filter
from cartpulse.llm.common import table
from cartpulse.llm.queries import LLM_ORACLE

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "a b c d"), (4, "a b c d"), (5, " \t\n"), (None, "a b c d"), (3, "a b c d"), (6, "word " * 30_000), (None, None)]


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + extra)


def rounded(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, cur = E.queries()[name](spark, SF), con.execute(LLM_ORACLE[name])
    cols = sorted(df.columns)
    order = [[d[0] for d in cur.description].index(c) for c in cols]
    assert sorted(d[0] for d in cur.description) == cols
    assert Counter(tuple(rounded(r[c]) for c in cols) for r in df.collect()) == Counter(tuple(rounded(r[i]) for i in order) for r in cur.fetchall())


# ------------------------------------------------------------------ secrets

def brute_secrets(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        out += [("assign", m.start(), m.end())] if len(m.group(2)) >= 6 else []
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out, key=lambda x: (x[1], ("assign", "access", "hex").index(x[0])))


PARTS = st.sampled_from(["password", "PassWD", "api_key", "APIKEY", "token", "to\u212aen", ":", "=", " ", '"', "'", "abc12", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "f" * 9, "é", "-", "\n"])


@given(st.lists(PARTS, max_size=14))
@settings(max_examples=400, deadline=None)
def test_base_secrets(parts):
    text = "".join(parts)
    assert [(secrets.KINDS[k], s, e) for s, k, e in secrets.base_spans(text)] == brute_secrets(text)


@given(st.text(alphabet="ab0123456789XYzw", max_size=80))
@settings(max_examples=200, deadline=None)
def test_sliding_entropy(run):
    window, least = 20, 3.2
    want = set()
    for i in range(len(run) - window + 1):
        part = run[i:i + window]
        h = -sum(c / window * math.log2(c / window) for c in Counter(part).values())
        if h >= least - 1e-12 and any(c.isalpha() for c in part) and any(c.isdigit() for c in part):
            want |= set(range(i, i + window))
    assert {i for s, e in secrets.flagged_windows(run, window, least) for i in range(s, e)} == want


def test_allow_list():
    key = "q9Zx7Lk2Vb5Nt8Rw3Ypc1Md6"
    assert secrets.entropy_spans(f"key {key}.") == [(4, 4 + len(key))]
    assert not secrets.entropy_spans("id 123e4567-e89b-12d3-a456-426614174000") and not secrets.entropy_spans(f"sha256: {key}")
    assert not secrets.entropy_spans(f"https://a.b/{key}") and not secrets.entropy_spans("internationalisations") and not secrets.entropy_spans("example" + key)


def test_links_hide_no_keys():
    """Host and path of a link, however long, are no secrets; its user part and query are scanned."""
    key = "q9Zx7Lk2Vb5Nt8Rw3Ypc1Md6"
    flagged = lambda t: [t[s:e] for s, e in secrets.entropy_spans(t)]
    assert flagged(f"see https://h.io/hook?k={key} now") == [f"k={key}"] and flagged(f"https://u:{key}@host/a") == [key]
    assert flagged(f"http://a.b/x#{key}") == [key] and flagged(f"x://a.b/@{key}") == [] and flagged(f"'http://a.b' {key}") == [key]
    long = "https://a.b/" + "part.of.a.path." * 40
    assert flagged(long + key) == [] and flagged(f"{long}?{key}") == [key] and flagged(f"{long} {key}") == [key]
    assert flagged(f"sha-256   :  {key}") == [] and flagged(f"http://x {key} http://y/{key}") == [key]
    assert len(secrets.link_paths("://" * 50_000)) == 1 and secrets.link_paths("a" * 200_000) == []


def test_op1_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    for r in E.queries()["op1_secret_scan"](spark, SF).collect():
        base = brute_secrets(texts[r.doc_id])
        kinds = [k for k, _, _ in base]
        names = [f"{k}:{s}:{e}" for k, s, e in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(kinds.count, ("assign", "access", "hex")))
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest() and set(names) <= set(r.spans.split(",")) | set()


def test_secrets_odd_rows(spark):
    rows = secrets.scan_secrets(frame(spark, [(*r, "x") for r in ODD], ", spans string")).collect()
    assert len(rows) == len(ODD) and all(r.spans == "" and r.n_hex == 0 for r in rows)
    assert secrets.scan_secrets(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ decontamination

def brute_hits(text, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    doc, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        grams = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(doc) - n + 1 if n else 0):
            if tuple(doc[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(doc), hit, found


@given(st.lists(st.sampled_from("abcdé"), max_size=60), st.lists(st.lists(st.sampled_from("abcx"), max_size=6), max_size=4))
@settings(max_examples=200, deadline=None)
def test_scan_against_brute_force(doc, items):
    text, named = " ".join(doc), [(str(i), " ".join(x)) for i, x in enumerate(items)]
    n, hits, found = decontaminate.scan(text.encode(), decontaminate.window_set([(i, t.encode()) for i, t in named], 4))
    assert (n, {i for s, e in hits for i in range(s, e)}, found) == brute_hits(text, named, 4)


def test_blocks_of_the_benchmark_give_the_same(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    one = sorted(map(tuple, decontaminate.contamination_report(docs, bench).collect()))
    assert one == sorted(map(tuple, decontaminate.contamination_report(docs, bench, max_set_words=1_500).collect()))
    assert any(r[5] for r in one)


def test_one_set_is_alive_at_a_time(spark, monkeypatch):
    """An item longer than the bound is split, every block is scanned by one Python stage, and released before the next."""
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(900))), (2, "w5 w6 w7"), (3, " ".join(f"w{i}" for i in range(300, 420)))], "item_id long, text string")
    docs = frame(spark, [(1, " ".join(f"w{i}" for i in range(200, 700))), (2, "x w5 w6 w7 y"), (3, "w1 w2"), (4, " ".join(f"w{i}" for i in range(890, 900)))])
    want = sorted(map(tuple, decontaminate.contamination_report(docs, bench).collect()))
    released, alive = [], []
    context = type(spark.sparkContext)
    real = context.broadcast

    def counted(self, value):
        shared = real(self, value)
        alive.append(len(value[0]))
        destroy = shared.destroy
        monkeypatch.setattr(shared, "destroy", lambda *a: (released.append(len(alive)), destroy(*a)), raising=False)
        return shared

    monkeypatch.setattr(context, "broadcast", counted)
    report = decontaminate.contamination_report(docs, bench, max_set_words=2_000)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and len(alive) > 3 and released == list(range(1, len(alive)))
    assert sorted(map(tuple, report.collect())) == want and [r[2] for r in want] == [500, 3, 0, 10]


@pytest.mark.parametrize("name", ["a.b", "my col", "back`tick", "row", "id"])
def test_stages_take_any_column_name(spark, name):
    rows = [(1, "one two three a@b.org " * 20, 0), (2, "one two three a@b.org " * 20, 1), (2, "other words here", 2), (None, None, 3)]
    docs = spark.createDataFrame(rows, StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField(name, LongType())]))
    bench = spark.createDataFrame([(1, "nothing of this")], "item_id long, text string")
    for out in (decontaminate.decontaminate(docs, bench), pii.redact(docs), simhash.dedup(docs)):
        assert out.columns == docs.columns and out.count() >= 3


def test_decontamination_odd_rows(spark):
    bench = spark.createDataFrame([(1, "b c"), (2, None), (None, "a b"), (3, "..."), (1, "b c")], "item_id long, text string")
    rows = decontaminate.contamination_report(frame(spark, [(*r, 0) for r in ODD], ", hits int"), bench).collect()
    assert sorted(((r.doc_id or -1), r.n_words, r.n_hit, r.n_items) for r in rows) == [
        (-1, 0, 0, 0), (-1, 4, 2, 1), (1, 0, 0, 0), (2, 0, 0, 0), (3, 4, 2, 1), (3, 4, 2, 1), (4, 4, 2, 1), (5, 0, 0, 0), (6, 30_000, 0, 0)]
    kept = decontaminate.decontaminate(frame(spark, [(*r, 0) for r in ODD], ", hits int"), bench)
    assert kept.count() == 5 and kept.columns == ["doc_id", "text", "hits"]
    assert decontaminate.decontaminate(frame(spark, ODD), bench.limit(0)).count() == len(ODD)
    assert decontaminate.decontaminate(frame(spark, []), bench).count() == 0


def test_remove_spans():
    assert decontaminate.remove_spans("Eins, zwei DREI! vier", [(1, 3)]) == "Eins, ! vier"


# ------------------------------------------------------------------ personal data

def brute_pii(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


BITS = st.sampled_from(["a", "b.c", "@", ".", "x.org", "@x.org", "_", "%", "+", "-", " ", "  ", "1", "25", "300", "10.2.3.4", "4111111111111111", "4111 1111", "+1 (555) 123-4567", "(", ")", "é", "\n", "0" * 25])


@given(st.lists(BITS, max_size=12))
@settings(max_examples=600, deadline=None)
def test_base_personal_data(parts):
    text = "".join(parts)
    assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)[0]] == brute_pii(text)


def test_message_passing_is_exact_on_trees():
    rnd = np.random.default_rng(0)
    n, edges = 5, np.array([(0, 1), (1, 2), (1, 3), (3, 4)])
    unary, pair = rnd.normal(size=(n, pii.LABELS)), rnd.normal(size=(len(edges), pii.LABELS, pii.LABELS))
    grid = np.indices((pii.LABELS,) * n).reshape(n, -1)
    score = sum(unary[i][grid[i]] for i in range(n)) + sum(pair[k][grid[a], grid[b]] for k, (a, b) in enumerate(edges))
    p = np.exp(score - score.max())
    want = np.array([[p[grid[i] == x].sum() for x in range(pii.LABELS)] for i in range(n)]) / p.sum()
    assert np.allclose(pii.marginals(unary, edges, pair, sweeps=80), want, atol=1e-6)


def test_skip_edges_link_repeats_linearly():
    tokens, _, chain, skip = pii.graph("call 5551234567 then " * 50)
    assert len(tokens) == 50 and len(skip) == 49 and not chain


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text"))


@pytest.mark.parametrize("known_at", [0, 20, 49])
def test_known_data_reaches_all_repeats(field, known_at):
    """The number is known once, by its '+'; alone, no bare repeat of it counts as personal data."""
    words = ["call 15551234567 now"] * 50
    assert pii.find_spans([" ".join(words)], field) == [([], [])]
    words[known_at] = "call +15551234567 now"
    (known, added), = pii.find_spans([" ".join(words)], field)
    assert len(known) == 1 and len(added) == 49 and {k for k, _, _ in added} == {3}


@pytest.mark.parametrize("known, other", [
    ("+49 30 901820", "030 901820"), ("+49 30 901820", "30 901820"), ("+49 30 901820", "0049 30 901820"), ("+49301234567", "0301234567"),
    ("+1 555 123 4567", "555 123 4567"), ("+15551234567", "5551234567"), ("+15551234567", "555 123 4567"), ("+1 (555) 123-4567", "555.123.4567"),
    ("4111111111111111", "4111  1111  1111  1111"), ("4111 1111 1111 1111", "4111.1111.1111.1111"), ("10.0.0.1", "10[.]0[.]0[.]1")])
def test_known_data_in_another_notation(field, known, other):
    (base, added), = pii.find_spans([f"we have {known} here; then {other} there, once more {other} then"], field)
    assert len(base) == 1 and [(k, e - s) for k, s, e in added] == [(base[0][0], len(other))] * 2


def test_other_numbers_do_not_join(field):
    text = "call +1 555 123 4567 or +49 30 901820, in 1820 and 820 rooms, order 99991234567, part 12 5 4567, 2 30 901821"
    assert pii.find_spans([text], field)[0][1] == [] and pii.graph(text, pii.base_spans(text)[0])[3] == []
    assert len(pii.graph("call +1 555 123 4567 then " * 50)[3]) == 4 * 49


def test_repeats_side_by_side(field):
    text = "call +49 30 901820 or " + "030 901820 " * 5
    (_, added), = pii.find_spans([text], field)
    assert not re.search("[0-9]", pii.redacted(text, added).split(" or ")[1])


def test_evidence_crosses_a_long_chain():
    """Message passing ends when messages rest, not after a number of sweeps: the far end is exact too."""
    n = 60
    unary, same = np.zeros((n, pii.LABELS)), np.where(np.eye(pii.LABELS) > 0, 6.0, 0.0)
    unary[0, 4] = 30
    p = pii.marginals(unary, np.array([(i, i + 1) for i in range(n - 1)]), np.stack([same] * (n - 1)))
    step = np.exp(same) / np.exp(same).sum(axis=1, keepdims=True)
    assert np.allclose(p[-1], np.linalg.matrix_power(step, n - 1)[4], atol=1e-3)


def test_swinging_messages_come_to_rest():
    pairs = np.array([(a, b) for a in range(5) for b in range(a)])
    unary = np.random.default_rng(1).normal(size=(5, pii.LABELS))
    assert np.isfinite(pii.marginals(unary, pairs, np.stack([-25.0 * np.eye(pii.LABELS)] * len(pairs)))).all()


def test_op4_against_brute_force_and_added_spans(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    rows = E.queries()["op4_pii"](spark, "/root/testdata/sf0.01").collect()
    order = {k: i for i, k in enumerate(pii.KINDS)}
    for r in rows:
        base = sorted(brute_pii(texts[r.doc_id]), key=lambda x: (order[x[0]], x[1]))
        names = [f"{k}:{s}:{e}" for k, s, e in base]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in base) for x in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        spans = [x for x in r.spans.split(",") if x]
        assert set(names) <= set(spans) and len(spans) == len(names) + r.n_added
        if not re.search("[0-9@]", texts[r.doc_id]):
            assert not spans


def test_field_finds_held_out_data(spark):
    """Trained on one half of the labelled documents, it tags known data whose spans are hidden in the other half."""
    docs = table(spark, "/root/testdata/sf0.1", "documents").select("doc_id", "text")
    model = pii.train(docs.filter("doc_id % 2 = 0"))
    right = total = wrong = none = 0
    for r in docs.filter("doc_id % 2 = 1 and text rlike '[0-9]'").collect():
        tokens, features, chain, skip = pii.graph(r.text)
        labels = pii.token_labels(tokens, *pii.base_spans(r.text))
        edges = np.array(chain + skip, np.int64).reshape(-1, 2)
        pots = np.stack([model["chain"]] * len(chain) + [model["skip"]] * len(skip)) if len(edges) else np.zeros((0, pii.LABELS, pii.LABELS))
        p = pii.marginals(np.array([model["unary"][on].sum(axis=0) for on in features]).reshape(-1, pii.LABELS), edges, pots) if tokens else []
        for q, label in zip(p, labels):
            if label > 0:
                total, right = total + 1, right + (q.argmax() == label)
            elif label == 0:
                none, wrong = none + 1, wrong + (q.argmax() != 0 and q.max() >= pii.LEAST)
    assert total > 100 and right / total > 0.95 and wrong <= 0.05 * none


def test_rare_personal_data_trains_the_field(spark):
    """Three documents of 6000 hold known data, none of them among the 4000 smallest document hashes."""
    rare = [r.id for r in spark.range(6000).orderBy(F.xxhash64("id").desc(), "id").limit(3).collect()]
    docs = frame(spark, [(i, f"mail a{i}@b.org now" if i in rare else "only words, page 12") for i in range(6000)])
    rows, stands = pii.sample(docs, 50)
    assert Counter(r.label for r in rows) == {0: 50, 1: 3} and stands[1] == 1 and 60 < stands[0] < 240
    assert pii.train(docs, 250) is not None and pii.train(docs.filter("text like 'only%'")) is None


def test_sample_is_the_same_however_the_table_is_cut(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    one, many = (pii.sample(docs.repartition(n), 20) for n in (1, 7))
    assert one[0] == many[0] and (one[1] == many[1]).all() and max(Counter(r.label for r in one[0]).values()) == 20


def test_redaction_and_odd_rows(spark):
    rows = [(*r, 5) for r in ODD] + [(7, "mail a@b.org, 10.0.0.1.", 23)]
    out = pii.redact(frame(spark, rows, ", n_email int"), length_col="n_email")
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == ["doc_id", "text", "n_email"] and out.count() == len(rows)
    assert got[7].text == "mail [EMAIL], [IP]." and got[7].n_email == len(got[7].text) and got[1].text is None
    assert pii.redact(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ quality

def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    rep = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(rep)


def test_quality_counts_on_hard_texts(spark):
    texts = [None, "", "a b a b a b a", "x x x x", "a b c\na b c\n\na b c ", "é\x0b漢 # |", "a\x1cb c\x85d", "word " * 20_000 + "end of it", "p q r s p q r s q r", "one two", "one two three"]
    rows = quality_rules.quality_report(frame(spark, list(enumerate(texts)))).collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(texts[r.doc_id]), r


def test_line_rules_and_cleaning(spark):
    prose = "\n".join(f"Sentence{i} says{i} something{i} of{i} its{i} own{i}, and ends{i} well{i}." for i in range(12))
    bad = "Home | About | Contact | Help\nWe use cookies, please accept cookies now.\nMenu\n### *** $$$ %%%\nBUY!! NOW!! CHEAP!!"
    rows = [(1, prose, 9), (2, prose + "\n" + bad, 9), (3, bad * 12, 9), (4, None, 9)]
    out = {r.doc_id: r for r in quality_rules.clean_documents(frame(spark, rows, ", n_words int"), length_col="n_words").collect()}
    assert set(out) == {1, 2} and out[1].text == prose and out[2].text == prose and out[2].n_words == len(prose)
    assert quality_rules.clean_documents(frame(spark, [])).count() == 0
    assert quality_rules.quality_report(frame(spark, ODD)).count() == len(ODD)


def test_quality_runs_no_python(spark):
    plan = E.queries()["op6_quality_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ------------------------------------------------------------------ URLs

def test_url_parts_and_rules(spark):
    urls = ["http://A.Example.NET/en/x?q#f", "x://net/", "http://example.com/de/", "http://example.com/des", "https://b.org/fr/y", "http://x.net", "nothing", None,
            "http://u?x://y/z", "http://h#f/p", "http://notnet/en/", "http://myexample.com/de/", "://", "http://example.net/EN/"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, rule int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, spark.createDataFrame([], "page_id long, bad int")).collect()}
    a = "allow"
    assert list(map(got.get, range(len(urls)))) == [
        ("a.example.net", "/en/x", "example.net/en/", a), ("net", "/", "net/", "block"), ("example.com", "/de/", "example.com/de/", "block"), ("example.com", "/des", None, a),
        ("b.org", "/fr/y", "org/fr/", a), ("x.net", "", None, a), ("", "", None, a), ("", "", None, a), ("u", "", None, a), ("h", "", None, a), ("notnet", "/en/", None, a),
        ("myexample.com", "/de/", None, a), ("", "", None, a), ("example.net", "/EN/", "net/", "block")]
    assert url_filter.judge_urls(pages.limit(0), spark.createDataFrame([], "page_id long, bad int")).count() == 0


def test_registered_domains(spark):
    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "x.y.com:8080", "y.com", "1.2.3.4", "1.2.3.4:80", "[::1]:5", "com", "", "a.x.b.kawasaki.jp", "1.2.3.4.com"]
    rows = spark.createDataFrame([(h,) for h in hosts], "host string")
    domain, suffix = url_filter._levels(F.col("host"), ("co.uk", "kawasaki.jp", "b.kawasaki.jp"))
    assert [tuple(r) for r in rows.select(domain, suffix).collect()] == [
        ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "uk"), ("y.com", "com"), ("y.com", "com"), ("1.2.3.4", "ip"), ("1.2.3.4", "ip"), ("[::1]", "ip"),
        ("com", "com"), ("", ""), ("x.b.kawasaki.jp", "b.kawasaki.jp"), ("4.com", "com")]


def test_urls_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "http://x.net/a", 5), (1, "http://x.net/a", 6), (None, "http://x.org/fr/", 7), (2, "http://" + "a" * 50_000 + ".org/", 8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host int").withColumn("a.b", F.lit(1)).withColumn("bad", F.lit(2))
    outcomes = spark.createDataFrame([(1, 0), (1, None), (None, 1), (2, 0), (2, 1)], "page_id long, bad int")
    got = sorted((r.page_id or 0, r.rule, r.verdict) for r in url_filter.judge_urls(pages, outcomes).collect())
    assert got == [(0, "org/fr/", "allow"), (1, "net/", "block"), (1, "net/", "block"), (2, None, "allow")]


def test_reputation_blocks_on_evidence_only(spark):
    hosts = {"spam.bad.com": (60, 60), "new.bad.com": (1, 1), "ok.good.com": (1, 60), "fresh.good.com": (1, 1), "b.bad.com": (40, 40), "c.good.com": (0, 50), "d.fine.org": (2, 80)}
    pages, labels, at = [], [], 0
    for host, (bad, n) in hosts.items():
        for i in range(n):
            pages.append((at, f"http://{host}/p{i}"))
            labels.append((at, int(i < bad)))
            at += 1
    got = {r.host: r.verdict for r in url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int")).collect()}
    assert {h for h, v in got.items() if v == "block"} >= {"spam.bad.com", "b.bad.com"} and got["fresh.good.com"] == got["ok.good.com"] == got["d.fine.org"] == "allow"


# ------------------------------------------------------------------ pipeline

def test_pipeline_against_its_parts(spark):
    docs = {r.doc_id: r.text for r in table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()}
    bench = [(str(r.item_id), r.text) for r in table(spark, "/root/testdata/sf0.01", "benchmark").collect()]
    one = decontaminate.window_set([(i, t.encode()) for i, t in bench])
    step = table(spark, "/root/testdata/sf0.01", "documents")
    columns, seen = step.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, "/root/testdata/sf0.01")
        assert step.columns == columns
        rows = step.collect()
        step = spark.createDataFrame(rows, step.schema)
        seen.append({r.doc_id: r.text for r in rows})
        assert len(seen[-1]) == len(rows) and all(r.n_chars == len(r.text) for r in rows)
    quality, near, clean, private = seen
    assert set(docs) > set(quality) > set(near) > set(clean) == set(private)
    assert all(len((t or "").split()) >= 50 for d, t in docs.items() if d in quality)
    copies = defaultdict(set)
    for d, t in quality.items():
        copies[t].add(d)
    assert all(len(c & set(near)) <= 1 for c in copies.values())
    assert set(clean) == {d for d, t in near.items() if not decontaminate.scan(t.encode(), one)[1]}
    assert not any(pii.base_spans(t)[0] for t in private.values())
    assert all(private[d] == clean[d] for d in private if not re.search("[0-9@]", clean[d]))
    assert {r.doc_id for r in corpus_pipeline.run(spark, "/root/testdata/sf0.01").collect()} == set(private)
