"""The divergence audit against plain Python, with digests that collide and texts in pieces."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigilog.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n string, term string, digest string, rank string, value string"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "n", "t", "d", "r", "v") for i, r in enumerate(rows)], SCHEMA).repartition(5)


def terms_of(text):
    lower = {c: c + 32 for c in range(65, 91)}
    return TERM.findall((text or "").translate(lower))


def brute(rows, least=30, top=50):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = terms_of(text)
        docs[lang].update(set(found))
        counts[lang, source].update(found)
        groups.add((lang, source))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        v = len(kept)
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(counts[g])

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (total + 5 * v) for t in kept}

        q = shares(whole)
        own = {s: shares(counts[lang, s]) for la, s in groups if la == lang}
        for s, p in own.items():
            pairs = [(o, sum(abs(p[t] - r[t]) for t in kept)) for o, r in own.items() if o != s]
            terms = [(t, p[t] - q[t]) for t in kept if counts[lang, s][t] and p[t] > q[t]]
            for part, items, last in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:last]
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items)}
    return out


def rows_of(df):
    rows = [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["été", "Straße", "ПРИВЕТ", "日本", "UPPER", "x" * 90, "x" * 89 + "y"]
    rows = []
    for i in range(260):
        lang = ["en", "de", None][min(i % 5, 2)]
        source = "hot" if i % 3 == 0 else f"s{i % 7}"
        n = int(rng.integers(0, 60))
        rows.append((" ".join(words[int(j)] for j in rng.zipf(1.3, n) % len(words)), lang, source))
    rows += [rows[0]] * 20 + [(None, "en", None), ("", "fr", "a"), ("only here", "fr", "b"), ("1 2 3 !", "en", "digits")]
    rows.append((" ".join(words) * 3, "en", "long"))
    return rows


@pytest.mark.parametrize("bits", [64, 7, 3])
def test_audit_equals_plain_python(spark, corpus, bits):
    assert rows_of(divergence.audit(frame(spark, corpus), least_docs=12, top=9, bits=bits)) == brute(corpus, 12, 9)


def test_digests_that_collide_are_split(spark, corpus):
    kept, strings, _ = divergence.kept_terms(frame(spark, corpus), least_docs=12, bits=5)
    assert kept.where("term is not null").count() > 0
    assert kept.where("term is null").join(strings, "digest").select("string").distinct().count() < 33


def test_long_texts_are_read_in_slices(spark, monkeypatch):
    big = "ab " * 600_000 + "c" * 1_500_000 + " ab"
    rows = [(big, "en", "a"), (big + " ab", "en", "b"), ("ab cc", "en", "a"), ("é" * 700_000, "en", "b")]
    assert rows_of(divergence.audit(frame(spark, rows), least_docs=1)) == brute(rows, 1)


def test_ties_of_the_last_rank_are_decided_by_their_strings(spark):
    rows = [("b a d c é z", "en", "s"), ("z", "en", "t")] * 3
    got = rows_of(divergence.audit(frame(spark, rows), least_docs=1, top=2))
    assert got == brute(rows, 1, 2)
    assert {r[3] for r in got if r[1] == "s" and r[2] == "term"} == {"a", "b"}


def test_empty_table_and_table_without_terms(spark):
    assert rows_of(divergence.audit(frame(spark, []))) == set()
    rows = [("a", "en", "x"), (None, "en", "y"), (None, None, None)]
    assert rows_of(divergence.audit(frame(spark, rows))) == brute(rows) == {
        ("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aAbzZé日 1@[`{\x00\x7f\n", max_size=30), max_size=6), st.integers(1, 64))
def test_words_of_texts(texts, bits):
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    joined = np.frombuffer(b"".join(data), np.uint8)
    counter = divergence._Counter(bits)
    found = counter.words(joined, offsets) if len(joined) else None
    got = Counter()
    for number, _, n in zip(*found, strict=True) if found else ():
        got[int(number)] += int(n)
    assert got == Counter({i: len(terms_of(t)) for i, t in enumerate(texts) if terms_of(t)})
    words = {w.encode() for t in texts for w in terms_of(t)}
    ends = {w for pair in counter.strings.values() for w in pair}
    assert ends <= words and (bits < 64 or ends == words)


@pytest.mark.parametrize("n,total", [(5, 5), (1, 3), (7, 2 ** 50 + 1), (2 ** 50, 2 ** 50 + 1), (999_999_999_999, 1_000_000_000_000)])
def test_shares_are_exact(spark, n, total):
    got = spark.createDataFrame([(n, total)], "n long, t long").select(divergence.share(*map(divergence.F.col, "nt"))).first()[0]
    assert got == 1 + 10 ** 9 * n // total


def test_only_digests_are_shuffled_to_count(spark, corpus):
    counted = divergence.count_terms(frame(spark, corpus)).where("digest is not null").select("lang", "source", "digest", "n", "docs")
    rows = counted.repartition("lang", "digest").groupBy("lang", "digest", "source").agg(
        divergence.F.sum("n").alias("n"), divergence.F.sum("docs").alias("docs"))
    plan = divergence._kept(rows, 30, ["digest"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "lo#" not in plan
