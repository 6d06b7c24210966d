"""Windows in documents against plain search, over one and several blocks."""

import random

import pytest

from keyedload.llm import decontam


def plain(text, items, size=10):
    words = decontam.words_of(text)
    hit, found = set(), set()
    for item, t in items:
        w = decontam.words_of(t)
        if not w:
            continue
        for k in range(max(1, len(w) - size + 1)):
            window = w[k : k + size]
            for s in range(len(words) - len(window) + 1):
                if words[s : s + len(window)] == window:
                    hit |= set(range(s, s + len(window)))
                    found |= {str(item)} - {"None"}
    return len(words), hit, sorted(found)


def example(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(25)] + ["é", "THE", "the"]

    def text(n):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", ",", ".\n"]) for _ in range(n))

    items = [(i, text(rng.choice([3, 9, 10, 14, 40]))) for i in range(12)]
    items += [(3, text(15)), (None, text(12)), (50, None), (51, "..."), (52, "same " * 30), (53, "a b")]
    docs = [(i, text(60)) for i in range(20)]
    for i, (_, t) in enumerate(items):
        if t:
            docs.append((100 + i, f"{text(20)} {t.upper()} {text(5)}"))
            docs.append((200 + i, f"x {' '.join(t.split()[:11])}; y"))
    docs += [(300, None), (301, ""), (302, "same " * 2000), (None, text(30)), (0, docs[0][1])]
    return docs, items


@pytest.mark.parametrize("block_windows", [100_000, 40])
def test_hits_are_those_of_plain_search(spark, block_windows):
    docs, items = example(spark)
    d = spark.createDataFrame([(*x, "c") for x in docs], "doc_id bigint, text string, spans string").repartition(4)
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id bigint, text string, t int")
    got = decontam.contamination(d, b, block_windows=block_windows).collect()
    assert len(got) == len(docs)

    def key(i, n, hit, found):
        return repr((i, n, sorted(hit), found))

    expected = sorted(key(i, *plain(t, items)) for i, t in docs)
    assert sorted(key(r.doc_id, r.n_words, {p for s in r.spans for p in range(s.start, s.end)}, r["items"]) for r in got) == expected


def test_items_without_an_id_are_hit_but_not_listed(spark):
    b = spark.createDataFrame([(None, "one two three four five six seven eight nine ten"), (7, "six seven eight")], "item_id bigint, text string")
    d = spark.createDataFrame([(1, "x One two three four five six seven eight nine ten y")], "doc_id bigint, text string")
    (r,) = decontam.contamination(d, b).collect()
    assert [tuple(s) for s in r.spans] == [(1, 11)] and r["items"] == ["7"]
    (r,) = decontam.contamination(d, b.where("item_id IS NULL")).collect()
    assert [tuple(s) for s in r.spans] == [(1, 11)] and r["items"] == []
    assert decontam.without_contaminated(d, b.where("item_id IS NULL")).count() == 0


def test_query_with_an_item_without_an_id(spark, tmp_path):
    import oracle

    from keyedload.llm import queries

    docs, items = example(spark)
    spark.createDataFrame([x for x in docs if x[0] is not None][:60], "doc_id bigint, text string").dropDuplicates(["doc_id"]).coalesce(1).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    spark.createDataFrame(items, "item_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = oracle.duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert oracle.differences(queries.QUERIES["op5_decontamination"](spark, str(tmp_path)), con, queries.DECONTAMINATION_SQL) is None


def test_clean_documents_stay_with_all_columns(spark):
    docs, items = example(spark)
    d = spark.createDataFrame([(*x, "c") for x in docs], "doc_id bigint, text string, items string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    kept = decontam.without_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(repr((i, t)) for i, t in docs if not plain(t, items)[1])


def test_no_items_and_no_documents(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    b = spark.createDataFrame([], "item_id bigint, text string")
    assert [(r.n_words, r.spans, r["items"]) for r in decontam.contamination(d, b).collect()] == [(3, [], [])]
    assert decontam.contamination(d.limit(0), d.toDF("item_id", "text")).count() == 0
