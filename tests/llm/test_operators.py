"""Every text operator against plain Python on small tables with nulls, ties, repeats, empty and long texts."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tests.llm import brute
from vigilog.llm import (
    components, decontaminate, exact_dedup, jaccard_join, license_scan, mixing, passage_dedup, sharding, similarity, text, token_store, toxicity,
    url_filter)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def prose(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(4000)}" for _ in range(n)]


def near(seed, n, edits):
    words, r = prose(seed, n), random.Random(seed * 31 + edits)
    for _ in range(edits):
        words[r.randrange(n)] = f"e{r.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def odd_rows():
    """Copies, near copies, nulls, empty, blank, repeated and very long texts."""
    rows = [(1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (5, "One TWO"), (6, "a b c d e"), (6, "a b c d e"), (None, "a b c d e"),
            (7, "ÉTÉ été"), (8, "été été"), (9, " ".join(prose(1, 30_000))), (10, "x " * 3000), (None, None)]
    rows += [(100 + i, near(5, 120, i % 7)) for i in range(60)]
    rows += [(200 + i, " ".join(prose(50 + i, 80) + prose(7, 60) + prose(90 + i, 40))) for i in range(8)]
    rows += [(300 + i, " ".join(prose(300 + i, 20 + 7 * i))) for i in range(20)]
    return rows


def same(df, expected, columns):
    got = Counter(tuple(r[c] for c in columns) for r in df.collect())
    assert got == Counter(expected)


def test_jaccard_join_is_exact(make_docs, odd_rows):
    want, sizes = brute.near_components(odd_rows)
    df = jaccard_join.near_duplicates(make_docs(odd_rows))
    # Documents without words are alone, whatever their ids.
    want = [d if not n else w for (d, _), n, w in zip(odd_rows, sizes, want)]
    same(df, [(d, n, w) for (d, _), n, w in zip(odd_rows, sizes, want)], ["doc_id", "n_shingles", "component_id"])
    kept = df.where("keep").collect()
    assert len(kept) == sum(n == 0 for n in sizes) + len({w for n, w in zip(sizes, want) if n})


def test_jaccard_join_spreads_hot_keys(make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr("vigilog.llm.similarity.HOT_LOCAL", 2)
    monkeypatch.setattr("vigilog.llm.similarity.FLUSH", 200)
    rows = [r for r in odd_rows if r[0] and r[0] >= 100]
    want, sizes = brute.near_components(rows)
    same(jaccard_join.near_duplicates(make_docs(rows)), [(d, w) for (d, _), w in zip(rows, want)], ["doc_id", "component_id"])


def test_jaccard_join_has_every_link(make_docs, odd_rows):
    odd_rows = odd_rows + [(500 + i, near(9, 400, 2 + i)) for i in range(12)]
    sets = [brute.shingles(t) for _, t in odd_rows]
    distinct = sorted(set(sets) - {frozenset()}, key=sorted)
    similar = [(x, y) for i, x in enumerate(distinct) for y in distinct[i + 1:] if 4 * len(x & y) >= 3 * len(x | y)]
    count = Counter(x for pair in similar for x in pair)
    df, pairs = jaccard_join.joined(make_docs(odd_rows))
    got = df.collect()
    want, _ = brute.near_components(odd_rows)
    assert Counter((r["doc_id"], r["component_id"], r["links"]) for r in got) == Counter(
        (d, w if s else d, count[s]) for (d, _), w, s in zip(odd_rows, want, sets))
    named = {}
    for r in got:
        named.setdefault(r["cls"], set()).add(r["doc_id"])
    by_set = {}
    for (d, _), s in zip(odd_rows, sets):
        by_set.setdefault(s, set()).add(d)
    as_ids = lambda x, y, names: frozenset((frozenset(names[x]), frozenset(names[y])))
    assert Counter(as_ids(r["a"], r["b"], named) for r in pairs.collect()) == Counter(as_ids(x, y, by_set) for x, y in similar)
    assert max(count.values()) > 5


def test_link_counts_make_no_row_per_pair(spark, monkeypatch):
    """Sixty sets of one component, in blocks of about eight: exact counts from rows that grow with blocks, not with pairs."""
    monkeypatch.setattr("vigilog.llm.similarity.CELL_CLASSES", 8)
    r = np.random.default_rng(4)
    sets = [np.unique(np.r_[r.choice(60, 52, replace=False), 1000 + 10 * i + np.arange(i % 4)]).astype(np.uint64) for i in range(60)]
    sets += [np.arange(5000 + 100 * i, 5030 + 100 * i + j).astype(np.uint64) for i in range(3) for j in (0, 2)]
    roots = [0] * 60 + [60, 60, 62, 62, 64, 64]
    linked = spark.createDataFrame(list(enumerate(roots)), "node long, root long")
    marks = spark.createDataFrame([(i, len(x)) for i, x in enumerate(sets)], "cls long, n long")
    items = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sets)], "cls long, items binary")
    found = similarity.cells(linked, marks, lambda wanted: items.join(wanted, "cls"))
    assert found.count() == 60 * 8 + 6
    want = {(i, j) for i in range(66) for j in range(i + 1, 66) if roots[i] == roots[j]
            and 4 * len(np.intersect1d(sets[i], sets[j])) >= 3 * len(np.union1d(sets[i], sets[j]))}
    assert 300 < len(want) < 60 * 59 // 2
    assert sorted(tuple(x) for x in similarity.all_links(found).collect()) == sorted(want)
    count = Counter(x for pair in want for x in pair)
    assert {x["cls"]: x["links"] for x in similarity.link_counts(found).collect() if x["links"]} == count


def test_components_run_no_round_without_further_links(spark, monkeypatch):
    known = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (7, 5)], "node long, root long")
    none = spark.createDataFrame([], "a long, b long")
    calls, real = [], similarity.components
    monkeypatch.setattr("vigilog.llm.similarity.components", lambda edges: calls.append(1) or real(edges))
    assert sorted(map(tuple, similarity._joined(known, none).collect())) == [(1, 1), (2, 1), (5, 5), (7, 5)] and not calls
    more = spark.createDataFrame([(2, 7), (8, 9)], "a long, b long")
    assert sorted(map(tuple, similarity._joined(known, more).collect())) == [(1, 1), (2, 1), (5, 1), (7, 1), (8, 8), (9, 8)] and calls


def test_components_of_one_task_need_no_round_and_nothing_is_broadcast(spark, monkeypatch):
    """A chain that one task holds is written once; one that tasks share takes rounds whose joins send nothing through the driver."""
    tables, real, plans = [], components.durable, []
    monkeypatch.setattr("vigilog.llm.components.durable", lambda df, label: tables.append(label) or plans.append(df) or real(df, label))
    chain = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    want = [(i, 0) for i in range(201)]
    assert sorted(map(tuple, components.components(chain.coalesce(1)).collect())) == want and len(tables) == 1
    shared = components.components(chain.repartition(7))
    assert sorted(map(tuple, shared.collect())) == want and 1 < len(tables) < 8
    assert all("Broadcast" not in x._jdf.queryExecution().executedPlan().toString() for x in plans)


def test_a_hot_key_is_not_cut_off_behind_an_unmarked_row(spark):
    """Class 1 comes without a mark first; its key is hot in the other flush, so class 9 must meet classes 2 and 3."""
    def packed(classes, hot_local):
        n = len(classes)
        batch = similarity.pack(np.full(n, 5, np.uint32), np.array(classes, np.int64), np.full(n, 80), np.full(n, 84), 4, hot_local)
        return [tuple(r.values()) for r in batch.to_pylist()]

    df = spark.createDataFrame(packed([1, 9], 3) + packed([1, 2, 3], 3), similarity.POSTINGS).coalesce(1)
    tiles = {}
    for r in similarity.shared_tiles(df, 4).collect():
        tiles.setdefault(r["tile"], set()).add(r["cls"])
    assert any(t == {1, 2, 3, 9} for t in tiles.values())


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(1, None), (5, 5)]
    df = components.components(spark.createDataFrame(edges, "a long, b long"))
    same(df, list(brute.roots([e for e in edges if e[1] is not None]).items()), ["node", "root"])


def test_exact_dedup(make_docs, odd_rows):
    rows = exact_dedup.digests(make_docs(odd_rows))
    df = exact_dedup.deduplicate(rows.where("doc_id < 105"), rows.where("doc_id >= 105 or doc_id is null"))
    groups = {}
    for d, t in odd_rows:
        groups.setdefault(brute.lower(t), []).append(d)
    best = {t: max((d for d in ds if d is not None), default=None) for t, ds in groups.items()}
    same(df, [(d, best[brute.lower(t)], len(groups[brute.lower(t)])) for d, t in odd_rows], ["doc_id", "keep_id", "group_size"])
    assert df.where("kept").count() == len(groups)


def test_perfect_hash_is_minimal_and_checked():
    keys = np.random.default_rng(1).integers(0, 256, 32 * 5000, dtype=np.uint8)
    shifts, slots = exact_dedup.build(keys)
    assert sorted(slots) == list(range(5000))
    stored = keys.reshape(-1, 32)[np.argsort(slots)].ravel()
    assert (exact_dedup.look_up(keys, shifts, stored) == slots).all()
    others = np.random.default_rng(2).integers(0, 256, 32 * 500, dtype=np.uint8)
    assert (exact_dedup.look_up(others, shifts, stored) == -1).all()


def test_license_scan(make_docs):
    texts = [None, "", "Released UNDER the MIT-License. (under the MIT license)", "Apache License, Version 2.0",
             "cc by-nc 4.0 and CC BY-NC-SA 4.0", "GNU General Public License, version 3", "under the mit licensed", "été " * 2000 + "cc-by-nc",
             "SPDX-License-Identifier: BSD-3-Clause"]
    df = {r["doc_id"]: r for r in license_scan.scan(make_docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        words = re.findall(license_scan.WORD, brute.lower(t))
        places, labels = [], set()
        for label, phrase, _ in license_scan.BASE:
            p = phrase.split()
            found = [k for k in range(len(words)) if words[k:k + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        r = df[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))), t
        assert labels <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert df[4]["labels"] == "cc-by-nc,cc-by-nc-sa" and df[5]["labels"] == "gpl-3" and df[8]["labels"] == "bsd-3-clause"
    assert len(license_scan.rules()) > 200
    for _, label, _, keyword, pattern, _ in license_scan.rules():
        assert keyword in pattern and re.compile(pattern), label


def test_decontaminate(spark, make_docs):
    items = [(1, "The train leaves Paris at 9 am and travels 120 km in 3 hours, how fast does it go?"), (2, "What is two plus two"),
             (3, None), (4, ""), (5, "tiny item")]
    leak = "noise words here the train leaves Berlin at 8 am and travels 200 miles in 5 hours, how fast does it go? more noise"
    broken = "the train leaves Paris at 9 am and then nothing at all of the kind follows in this text"
    rows = [(1, leak), (2, broken), (3, None), (4, ""), (5, "so what is seven plus seven then"), (6, "so what is seven plus nine then"),
            (7, items[0][1].upper()), (8, "a tiny item here"), (None, leak)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["changed"]) for r in decontaminate.leaks(make_docs(rows), bench).collect()}
    assert {(1, 1, True), (None, 1, True), (5, 2, True), (7, 1, False)} <= got
    assert not {d for d, *_ in got} & {2, 3, 4, 6}  # 6: one value of the item stands for two in the text
    assert {r["doc_id"] for r in decontaminate.drop_contaminated(make_docs(rows), bench).collect()} == {2, 3, 4, 6, 8}
    assert decontaminate.leaks(make_docs(rows), bench.limit(0)).count() == 0


def test_decontaminate_names_at_sentence_starts():
    items = [(1, "Alice has 3 apples. Alice buys 5 more. How many does Alice have?"),
             (2, "Maria rides 12 km in 2 hours. Tom walks behind Maria for 4 km.\nMaria waits for Tom.")]
    block, cache = decontaminate.Block(items), decontaminate.Tokens()
    find = lambda t: {(i, changed) for i, _, changed in block.matches(t.encode(), cache)}
    assert find("Some text. Bob has 7 apples. Bob buys 9 more. How many does Bob have? The end.") == {(1, True)}
    assert find("some text. alice has 7 apples. alice buys 9 more. how many does alice have? the end") == {(1, True)}
    assert find("Eve rides 30 miles in 5 hours. Bob walks behind Eve for 8 miles.\nEve waits for Bob.") == {(2, True)}
    assert find("maria rides 30 km in 5 hours. tom walks behind maria for 8 km. maria waits for tom.") == {(2, True)}
    assert find(items[0][1].lower()) == {(1, False)}
    # One name of the item stands for three, or two names of it for one.
    assert find("Bob has 7 apples. Carl buys 9 more. How many does Dora have?") == set()
    assert find("Eve rides 30 miles in 5 hours. Eve walks behind Eve for 8 miles.\nEve waits for Eve.") == set()
    assert find("Bob has 7 apples. And so on and on. Bob buys 9 more. How many does Bob have?") == set()  # 5 of 9 windows are left
    assert find("Eve rides 30 miles in 5 hours. Bob walks slowly behind Eve for 8 miles.\nEve waits for Bob.") == set()  # 10 of 14
    assert find("Clean words stand here. Nobody has 7 apples and nobody buys more.") == set()


def test_decontaminate_words_by_plain_rules(monkeypatch):
    class Counted:
        asked, rule = 0, decontaminate._NUMBER

        def fullmatch(self, word):
            Counted.asked += 1
            return self.rule.fullmatch(word)

    words = ["Bob", "bob,", "BOB.", "The", "kg", "KG.", "twelve", "Twelve?)", "12", "3.5%", "$4.", "+", "-$%", "é", "École.", "été»", "mètre|", "five\"",
             "a1", "1a", "5th", "--", "K", "İx", "x.y", "ok!*", "٣", "²"] + [f"mot{chr(c)}" for c in range(0xE0, 0x17F)]
    monkeypatch.setattr(decontaminate, "_NUMBER", Counted())
    own, flags = decontaminate.Tokens().of([w.encode() for w in words])
    assert Counted.asked < 20  # the rule for numbers is asked only where one can begin
    for word, value, got in zip(words, own.tolist(), flags.tolist()):
        plain = word.strip(decontaminate._EDGE)
        low = plain.lower()
        want = bool(Counted.rule.fullmatch(plain) or low in decontaminate._NUMBER_WORDS) | 2 * (plain[:1].isupper() and plain[1:].islower()) \
            | 4 * (low in decontaminate.UNITS) | 8 * (word.rstrip("\"')]}»”*#&$%")[-1:] in (".", "!", "?", ":", "|")) \
            | 16 * (not low.strip("-+$%")) | 32 * (low in decontaminate._OPENERS)
        assert (value, got) == (xxhash.xxh64_intdigest(low), want), word


def test_toxicity(spark, make_docs):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        bad = i % 4 == 0
        rows.append((i, " ".join(prose(i, 40) + ([r.choice(["Vile!", "nasty", "rotten"])] if bad else []))))
        labels.append((i, int(bad)))
    rows += [(1000, None), (1001, ""), (None, "nasty")]
    df = toxicity.judge(make_docs(rows), spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")).collect()
    held = [x for x in df if x["held_out"] and x["doc_id"] is not None and x["doc_id"] < 900]
    assert {x["doc_id"] for x in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([x["predicted"] == (x["doc_id"] % 4 == 0) for x in held]) > 0.95
    assert len(df) == len(rows) and all(0 <= x["score"] <= 1 for x in df)


def test_pairs_of_terms_count():
    """Two terms that are toxic only together: no sum of weights separates them."""
    a, b, both, other = (np.array(x, np.int32) for x in ([11], [22], [11, 22], [33]))
    model = toxicity.fit_machine([a, b, both, other] * 100, np.array([0, 0, 1, 0] * 100), size=64)
    assert (model.scores([a, b, both]) >= 0.5).tolist() == [False, False, True]


def test_a_pair_alone_tells_the_classes(spark, make_docs):
    """Toxic with both words or with neither: by itself no word is more frequent in one class, so only pairs can tell."""
    r = random.Random(8)
    rows, labels = [], []
    for i in range(1600):
        one, two = r.random() < 0.5, r.random() < 0.5
        rows.append((i, " ".join([r.choice(["p", "q"]) + str(r.randrange(3)), "group" if one else "crowd", "insult" if two else "praise"])))
        labels.append((i, int(one == two)))
    df = toxicity.judge(make_docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    want = dict(labels)
    assert len(df) > 200 and np.mean([x["predicted"] == want[x["doc_id"]] for x in df]) > 0.95


@pytest.mark.parametrize("labels", [[], [(1, None)], [(1, 0), (2, 0)], [(None, 1)]])
def test_without_toxic_labels_nothing_is_toxic(spark, make_docs, labels):
    docs, table = make_docs([(1, "a b"), (2, None), (3, "")]), spark.createDataFrame(labels, "doc_id long, toxic int")
    assert all(x["predicted"] == 0 for x in toxicity.judge(docs, table).collect())
    docs = docs.withColumnRenamed("score", "_toxicity").withColumn("odd name", toxicity.F.lit(1))
    kept = toxicity.drop_toxic(docs, toxicity.train(docs, table))
    assert kept.count() == 3 and kept.columns == docs.columns
    assert toxicity.judge(docs.where("false"), table).count() == 0


def test_training_takes_what_fits(spark, make_docs):
    rows = [(i, " ".join(prose(i, 20))) for i in range(40)] + [(3, "again")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(45)], "doc_id long, toxic int")
    outside = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    whole = toxicity.sample(make_docs(rows), labels).collect()
    assert sorted(r["doc_id"] for r in whole) == outside and all(r["toxic"] == r["doc_id"] % 2 for r in whole)
    some = toxicity.sample(make_docs(rows), labels, terms=60).collect()
    first = sorted(whole, key=lambda r: r["place"])[:len(some)]
    assert {r["doc_id"] for r in some} == {r["doc_id"] for r in first} and 0 < sum(r["n"] for r in some) <= 60
    assert toxicity.sample(make_docs(rows), labels, terms=0).count() == 0 and toxicity.sample(make_docs(rows), labels, rows=7).count() <= 7


@pytest.mark.parametrize("limit", [1, 300, 2000, 10**9])
def test_sharding(make_docs, odd_rows, limit):
    rows = odd_rows[:40] + [(77, "same " * 20)] * 9
    df = sharding.assign(make_docs(rows), limit).collect()
    assert Counter(r["doc_id"] for r in df) == Counter(d for d, _ in rows)
    held = {}
    for r in df:
        held.setdefault(r["shard"], []).append(r)
    for shard, mine in held.items():
        assert sum(r["n_bytes"] for r in mine) == mine[0]["shard_bytes"] and len(mine) == mine[0]["shard_rows"]
        assert mine[0]["shard_bytes"] <= limit or len(mine) == 1
        assert all(not other.startswith(shard) for other in held if other != shard)
    for shard, mine in held.items():  # only what was too large was split
        if shard:
            parent = [r for s, rs in held.items() if s.startswith(shard[:-1]) for r in rs]
            assert sum(r["n_bytes"] for r in parent) > limit
    assert sharding.assign(make_docs([(1, "x")]).where("false"), limit).count() == 0


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://a.org/x", "https://EXAMPLE.org/es/1", "http://www.example.org/en/12?q#f", "http://example.org/en/2",
            "http://example.com/fr/9", "http://example.com/de/9", "http://org", "http://notorg/x", "http://a.net/en/5?utm=1&b=2", "x://y://z/q"]
    urls += [f"http://h{i}.example.com/{('fr', 'de')[i % 2]}/{i}" for i in range(60)]
    df = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    rules = {3: "org/", 4: "example.org/es/", 5: "example.org/en/1", 6: "org/", 7: "com/fr/", 8: "com/de/"}
    verdicts = {r: v for v, r in url_filter.RULES}
    for i in range(13):
        assert df[i]["rule"] == rules.get(i), urls[i]
        assert df[i]["verdict"] in ("allow", "block")
        if i in rules:
            assert df[i]["verdict"] == verdicts[rules[i]]
    assert (df[4]["host"], df[5]["path"], df[0]["host"], df[2]["path"], df[9]["path"]) == ("example.org", "/en/12", "", "", "")
    assert df[12]["host"] == "y:"
    none = url_filter.judge(spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")).collect()
    assert [r["verdict"] for r in none] == ["allow"]


def test_url_filter_samples_each_class_to_its_bound(spark):
    """A rare class stays in the sample, and one URL with a third of the rows does not break the bound."""
    rows = [(i, "hot" if i % 3 == 0 else f"u{i}", 1.0) for i in range(6000)] + [(9000 + i, f"rare{i}", 0.0) for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, label double")
    got = Counter(r["label"] for r in url_filter.class_samples(df, {1.0: 6000, 0.0: 3}, 200).collect())
    assert got == {1.0: 197, 0.0: 3}
    copies = spark.createDataFrame([(1, "one", 1.0)] * 5000 + [(2, "two", 0.0)] * 4000, "page_id long, url string, label double")
    got = Counter(r["label"] for r in url_filter.class_samples(copies, {1.0: 5000, 0.0: 4000}, 90).collect())
    assert got == {1.0: 50, 0.0: 40}


def test_token_store_round_trip(spark, make_docs, odd_rows, tmp_path):
    rows = odd_rows + [(900, "Don't <|endoftext|> STOP!! x'. é. 3.14 naïve\u00a0word ΑΣ. fin#*"), (901, "<|STARTOFTEXT|>..."), (902, "a'.b")]
    path = str(tmp_path / "store")
    token_store.write(make_docs(rows), path, TOKENIZER)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    df = token_store.read(spark, path).orderBy("start").collect()
    ids = [None if r["doc_id"] is None else r["doc_id"] for r in df]
    assert ids == sorted(ids, key=lambda d: -1 if d is None else d)
    want = Counter((d, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for d, t in rows)
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in df) == want
    start = 0
    for r in df:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"]) // 4
        start += r["n_tokens"]
    empty = str(tmp_path / "empty")
    token_store.write(make_docs(rows).where("false"), empty, TOKENIZER)
    assert token_store.read(spark, empty).count() == 0


def test_code_is_optimal_within_its_limit():
    counts = np.array([2 ** i for i in range(24)] + [0])
    lengths = token_store.code_lengths(counts, 8)
    assert lengths.max() <= 8 and lengths[-1] == 0 and sum(2.0 ** -float(x) for x in lengths[:-1]) == 1
    assert (np.diff(lengths[:-1].astype(int)) <= 0).all()


def test_mixing(make_docs):
    rows = [(i, "a " * (i % 40), ("big", "mid", "zero", None)[min(i % 7, 3)]) for i in range(400)] + [(999, None, "empty")]
    df = mixing.plan(make_docs(rows)).collect()
    sizes = {}
    for d, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[x] for x in sizes if x not in full) for s in sizes if s not in full}
        over = {s for s, v in share.items() if v > 3 * sizes[s]}
        if not over:
            break
        full |= over
    target = {**{s: 3 * sizes[s] for s in full}, **share}
    for r in df:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] <= 3 * r["size"] and r["copies"] in (int(r["rate"]), int(r["rate"]) + 1)
    out = Counter(r["doc_id"] for r in mixing.mix(make_docs(rows)).collect())
    assert out == Counter({r["doc_id"]: r["copies"] for r in df if r["copies"]})
    assert {r["doc_id"]: r["copies"] for r in mixing.plan(make_docs(rows[::-1])).collect()} == {r["doc_id"]: r["copies"] for r in df}


def test_passage_dedup(make_docs, odd_rows):
    df = {r["doc_id"]: r for r in passage_dedup.removals(make_docs(odd_rows)).collect()}
    assert set(range(201, 208)) <= set(df) and 200 not in df  # the shared passage of sixty words
    for i in range(201, 208):
        assert df[i]["keep_ids"] == [200] and all(60 <= a and b <= 160 for a, b in df[i]["spans"])
    assert not set(df) & {None, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, *range(300, 320)}
    assert passage_dedup.removals(make_docs(odd_rows).where("false")).count() == 0


def edited(words, places):
    return [f"changed{i}" if i in places else w for i, w in enumerate(words)]


def test_passage_dedup_finds_near_paragraphs(make_docs):
    """Every pair of paragraphs with similarity 0.75 or more by brute force, among others, in lines, wrapped blocks and long lines."""
    r, rows = random.Random(5), []
    cases = [(n, k) for n in (12, 25, 40, 60, 100, 150) for k in (1, 2, 3) for _ in range(4)]
    texts, want = {}, set()
    for i, (n, k) in enumerate(cases):
        one = prose(5000 + i, n)
        two = edited(one, set(r.sample(range(n), k)))
        wrap = (lambda w: "\n".join(" ".join(w[j:j + 12]) for j in range(0, len(w), 12))) if i % 4 == 3 else " ".join
        gap = "\n\n" if i % 4 == 3 else "\n"
        texts[i] = " ".join(one), " ".join(two)
        rows.append((2 * i, gap.join([" ".join(prose(7000 + i, 40)), wrap(one), " ".join(prose(8000 + i, 30))])))
        rows.append((2 * i + 1, gap.join([" ".join(prose(9000 + i, 50)), wrap(two)])))
        if brute.near_components(list(enumerate(texts[i])))[0][1] == 0:
            want.add(i)
    assert len(want) > 30 and {k for i, (_, k) in enumerate(cases) if i in want} == {1, 2, 3}
    got = {r["doc_id"]: r for r in passage_dedup.removals(make_docs(rows)).collect()}
    missed = [cases[i] for i in want if 2 * i + 1 not in got]
    assert not missed
    for i in want:
        assert got[2 * i + 1]["spans"] == [[50, 50 + cases[i][0]]] and got[2 * i + 1]["keep_ids"] == [2 * i]
    assert not {d for d in got if d % 2 == 0}


def test_passage_dedup_spans_are_exact(make_docs):
    """From the first to the last word of the passage, at every place in a document."""
    rows, want = [], {}
    for i, n in enumerate((51, 52, 60, 80, 130)):
        shared = prose(600 + i, n)
        a, b, c = prose(610 + i, 33 + i), prose(620 + i, 45), prose(630 + i, 27)
        rows += [(2 * i, " ".join(prose(640 + i, 70) + shared + prose(650 + i, 50))), (2 * i + 1, " ".join(a + shared + b + shared + c))]
        want[2 * i + 1] = [[33 + i, 33 + i + n], [78 + i + n, 78 + i + 2 * n]]
    found = {r["doc_id"]: r for r in passage_dedup.removals(make_docs(rows)).collect()}
    assert {d: r["spans"] for d, r in found.items()} == want
    assert all(r["removed_words"] == sum(b - a for a, b in want[d]) and r["keep_ids"] == [d - 1] for d, r in found.items())


def test_passage_dedup_finds_near_copies_inside_long_lines(make_docs):
    shared = prose(77, 300)
    rows = [(1, " ".join(prose(1, 200) + shared + prose(2, 200))), (2, " ".join(prose(3, 150) + edited(shared, set(range(20, 300, 40))) + prose(4, 90)))]
    found = {r["doc_id"]: r for r in passage_dedup.removals(make_docs(rows)).collect()}
    assert set(found) == {2} and found[2]["removed_words"] > 150


def test_words_are_cut_at_ascii_white_space(make_docs):
    assert [len(s) for s in text.shingle_sets(["a\u00a0b c\x1cd".encode(), None, b""], text.WordHash())] == [1, 0, 0]
    assert [r["size"] for r in mixing.plan(make_docs([(1, "a\u00a0b c\x1cd\x0be")])).collect()] == [3]
