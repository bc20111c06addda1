"""Whole queries and the pipeline's run against plain versions on small tables."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from vigilog.llm import passage_dedup, queries, similarity, text, token_store, url_filter

FILE = public_tokenizers.path("word_bpe_49k.json")


def prose(seed, n):
    r = random.Random(seed)
    return [f"w{r.randrange(4000)}" for _ in range(n)]


def test_trees_learn_what_rules_show(spark):
    """Rules label URLs of com; URLs of net have no rule and a suffix no rule has seen, so only their shape can tell."""
    r = random.Random(4)

    def url(host, bad, path):
        tail = "/".join("".join(r.choice("0123456789abcdef") for _ in range(24)) for _ in range(3)) + "?a=1&b=2&c=3" if bad \
            else r.choice(["news", "home", "about"])
        return f"http://{host}/{path}{tail}"
    urls = [url(f"h{i}.com", i % 2 == 1, ("fr/", "de/")[i % 2]) for i in range(400)]
    urls += [url(f"x{i}.net", i % 2 == 1, "") for i in range(200)]
    df = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).where("page_id >= 400").collect()
    assert len(df) == 200 and all(x["rule"] is None for x in df)
    assert np.mean([(x["verdict"] == "block") == (x["page_id"] % 2 == 1) for x in df]) > 0.95


def test_token_store_query_equals_the_tokenizer(make_docs):
    rows = [(5, "Don't STOP!! <|endoftext|> é. naïve word ΑΣ ÄÖÜß straßE."), (3, None), (9, ""), (1, " ".join(prose(1, 3000))),
            (7, "a\tb\nc"), (-4, "x " * 200)] + [(100 + i, " ".join(prose(i, 40)).title() + ".") for i in range(60)]
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_store.round_trip(make_docs(rows), FILE).collect()}
    tokenizer, start, want = Tokenizer.from_file(FILE), 0, {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want


@pytest.fixture(scope="module")
def small_corpus(tmp_path_factory):
    """Toxic, near-duplicate, contaminated and clean documents of three sources, one of them with a third of all."""
    folder, r, rows = tmp_path_factory.mktemp("corpus"), random.Random(2), []
    question = "the quick surveyor measured seven ancient bridges before noon and reported every crack to the council"
    for i in range(420):
        words = prose(i, 60)
        if i % 5 == 0:
            words[r.randrange(60)] = r.choice(["vile", "nasty", "rotten"])
        rows.append((i, words, ["big", "mid", "small"][0 if i % 3 == 0 else 1 + i % 2]))
    docs = [(i, " ".join(w), s) for i, w, s in rows]
    clean = [d for d in docs if d[0] % 5]
    near = [(1000 + k, " ".join([*d[1].split()[:-1], "changed"]), d[2]) for k, d in enumerate(clean[:40])]
    copies = [(2000 + k, clean[50][1], "mid") for k in range(12)]
    leaks = [(3000 + k, " ".join([*prose(9000 + k, 20), question, *prose(9500 + k, 20)]), "small") for k in range(10)]
    docs += near + copies + leaks + [(4000, None, "small"), (4001, "", None)]
    frame = pd.DataFrame(docs, columns=["doc_id", "text", "source"]).assign(lang="en", n_chars=1)
    frame[["doc_id", "text", "lang", "source", "n_chars"]].to_parquet(f"{folder}/documents.parquet", index=False)
    pd.DataFrame([(i, 1, int(i % 5 == 0)) for i in range(420)], columns=["doc_id", "quality", "toxic"]).to_parquet(
        f"{folder}/labels.parquet", index=False)
    pd.DataFrame([(1, question)], columns=["item_id", "text"]).to_parquet(f"{folder}/benchmark.parquet", index=False)
    return folder, docs


def test_the_pipeline_equals_plain_stages(spark, small_corpus):
    folder, docs = small_corpus
    # What the first stage learned is judged by its accuracy; all that follows is exact.
    table = spark.read.parquet(f"{folder}/documents.parquet")
    clean = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, table, str(folder)).collect()}
    toxic = {d[0] for d in docs if set(brute.words(d[1])) & {"vile", "nasty", "rotten"}}
    assert {d[0] for d in docs} - toxic <= clean and len(toxic - clean) >= 0.85 * len(toxic)
    kept = [d for d in docs if d[0] in clean]
    components, _ = brute.near_components([(i, t) for i, t, _ in kept])
    kept = [d for d, c in zip(kept, components, strict=True) if d[0] == c]
    kept = [d for d in kept if d[0] < 3000 or d[0] >= 4000]
    connection = duckdb.connect()
    connection.register("documents", pd.DataFrame(kept, columns=["doc_id", "text", "source"]))
    mixed = connection.execute(queries.CHECK_SQL["op9_mixing"]).df()
    want = Counter({int(d): int(taken // size) for d, taken, size in mixed[["doc_id", "taken", "size"]].to_numpy() if size > 0})
    got = corpus_pipeline.run(spark, str(folder)).collect()
    found = Counter(r["doc_id"] for r in got if r["doc_id"] < 4000)
    assert found == +want
    assert {r["shard"] for r in got} == {""} and {r["shard_rows"] for r in got} == {len(got)}


def test_sets_are_shuffled_once_and_only_wanted_ones_are_read_again(spark):
    """A set that its row has twice comes once, without an aggregation behind the join; of 200 sets the wanted ones are picked."""
    line = " ".join(f"w{i}" for i in range(9))
    docs = spark.createDataFrame([(0, 0, f"{line}\n\nother\n\n{line}"), (1, 1, line)], "row long, doc_id long, text string")
    places = passage_dedup._places(docs)
    chosen = places.groupBy("cls").agg(F.min("row").alias("row"))
    contents = passage_dedup._contents(docs, chosen)
    got = contents.select("cls").collect()
    assert len(got) == len(set(got)) == chosen.count() > 0
    assert "Aggregate" not in contents._jdf.queryExecution().optimizedPlan().toString().split("LeftSemi")[0]
    sets = spark.range(200).select(F.col("id").alias("cls"), F.lit(b"x").alias("items"))
    kept = {r.cls for r in similarity.picked(sets, spark.range(3).withColumnRenamed("id", "cls")).collect()}
    assert {0, 1, 2} <= kept and len(kept) < 20


def test_filter_of_classes_lets_few_others_through(spark):
    bits = similarity.class_filter(spark.range(20_000).withColumnRenamed("id", "cls"))
    assert similarity.may_have(bits, np.arange(20_000)).all()
    assert similarity.may_have(bits, np.arange(20_000, 220_000)).mean() < 0.01


def test_repeated_classes_are_found_across_flushes(spark, monkeypatch):
    monkeypatch.setattr("vigilog.llm.similarity.FLUSH", 3)
    classes = [5, 1, 1, 1, 2, -7, 3, 4, -7, 9]
    df = spark.createDataFrame([(x,) for x in classes], "cls long").repartition(3)
    assert sorted(r.cls for r in similarity.repeated(df, 2).collect()) == [-7, 1]
    assert similarity.repeated(df.where("cls > 100"), 2).count() == 0


def test_spans_of_a_batch_are_those_of_each_row(monkeypatch):
    monkeypatch.setattr("vigilog.llm.passage_dedup.PAIR_WORDS", 100)
    rng = np.random.default_rng(3)
    base, rows = rng.integers(0, 9, 200).astype(np.uint32), []
    for i in range(60):
        at, length = int(rng.integers(0, 120)), int(rng.integers(6, 40))
        lead = min(at, passage_dedup.MARGIN)
        words = base[at - lead:at + length + int(rng.integers(0, passage_dedup.MARGIN + 1))].copy()
        kept = []
        for _ in range(rng.integers(1, 5)):
            other = words.copy()
            other[rng.integers(0, len(words), 2)] += np.uint32(rng.integers(0, 2))
            other[:lead // 2] += np.uint32(rng.integers(0, 2))
            kept.append({"lead": lead, "length": length - int(rng.integers(0, 2)), "words": other.tobytes()})
        rows.append({"group_id": i % 7, "lead": lead, "length": length, "words": words.tobytes(), "kept": kept})
    kept = pa.list_(pa.struct([("lead", pa.int32()), ("length", pa.int32()), ("words", pa.binary())]))
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("group_id", pa.int64()), ("lead", pa.int32()), ("length", pa.int32()), ("words", pa.binary()), ("kept", kept)]))
    want = [passage_dedup.shared_span(np.frombuffer(r["words"], np.uint32), r["lead"], r["length"],
                                      [(np.frombuffer(k["words"], np.uint32), k["lead"], k["length"]) for k in r["kept"]]) for r in rows]
    for part, wanted in ((batch, want), (batch.slice(11, 20), want[11:31])):
        assert list(zip(*(x.tolist() for x in passage_dedup._spans(part, {})))) == wanted


def test_words_of_lines_are_those_of_split():
    """Hashes tell words apart as ``lower().split()`` does, across blocks and for words longer than a block."""
    texts = [None, b"", b"\n", b"A b\tC\n\n d\x0be\x0cf\rg", b"x" * 70_000 + b" Y y", b"  lead", b"trail \n", "\u00c4 \u00a0 z\u00e9".encode()]
    texts += [b" ".join(b"w%d" % (i * i % 977) for i in range(30_000))]
    of, sizes, hashes = text.line_words(texts)
    lines = [[x.split() for x in (t or b"").lower().split(b"\n")] for t in texts]
    assert of.tolist() == [i for i, t in enumerate(lines) for _ in t] and sizes.tolist() == [len(x) for t in lines for x in t]
    words = [w for t in lines for x in t for w in x]
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


def test_spots_carry_only_words_that_are_needed(spark):
    """Of the copies of a class that is linked to no other one, only the words around it are handed on; of a removed paragraph none."""
    line = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(0, 0, f"a b c\n{line}\nd"), (1, 1, f"{line}\ne f")], "row long, doc_id long, text string")
    spots = lambda links: passage_dedup._spots(docs, passage_dedup._places(docs).groupBy("cls").agg(F.count("*").alias("n"))
                                               .where("n = 2").select("cls", F.lit(0).cast("long").alias("keep_row"), F.lit(links).alias("links"))).collect()
    found = spots(False)
    assert {(r.row, r.length, r.left_out, r.lead, len(r.words)) for r in found if r.kind == passage_dedup.PARAGRAPH} \
        == {(0, 2, 38, 3, 4 * 6), (1, 0, 40, 0, 0)}
    windows = [r for r in found if r.kind == passage_dedup.WINDOW]
    assert windows and all(r.length == 2 and r.left_out == 28 and len(r.words) <= 4 * (2 + 2 * passage_dedup.MARGIN) for r in windows)
    assert {r.length for r in spots(True) if r.kind == passage_dedup.WINDOW} == {30}


def test_one_row_per_key_keeps_classes_apart_once(spark):
    keys, classes = np.arange(400, dtype=np.uint32), np.repeat(np.arange(4), 100).astype(np.int64)
    batch = similarity.pack(keys, classes, np.full(400, 80), np.full(400, 84), 1, 1_000)
    assert sum(len(v.as_py()) for name in batch.schema.names[1:] for v in batch.column(name)) < 400 * 6
    twice = pa.Table.from_batches([batch, similarity.pack(keys, classes + 10, np.full(400, 80), np.full(400, 84), 1, 1_000)]).to_pylist()
    found = similarity.shared_tiles(spark.createDataFrame([tuple(r.values()) for r in twice], similarity.POSTINGS), 1).groupBy("tile").agg({"cls": "collect_set"})
    assert {tuple(sorted(r[1])) for r in found.collect()} == {(i, i + 10) for i in range(4)}


def test_only_distinct_stems_are_looked_up():
    """Case and punctuation behind a word take no entry of their own; words that may hold a special token stay whole."""
    texts = ["Word word, WORD. word?! été, 9. <|endoftext|>, H̱. Word.", None, "T̈, İ. x٣: '."]
    words = token_store.WordIds(FILE, "<u2")
    ids, n = token_store.ids_of(pa.array(texts), words, "<u2", 2)
    assert ids.tolist() == [i for t in texts for i in [*Tokenizer.from_file(FILE).encode(t or "", add_special_tokens=False).ids, 2]] and n.sum() == len(ids)
    assert {b"word", b",", b"<|endoftext|>,"} <= set(words) and not {b"Word", b"WORD.", b"word,", "été,".encode(), b"9."} & set(words)
