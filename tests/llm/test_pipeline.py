"""The pipeline's stages on a small table, each against its operator's brute-force rule."""

from test_dedup import ROWS, brute_components, brute_removal, LOW

import corpus_pipeline
from compare import duck_rows, spark_rows
from tenderloom.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    one = stages["language_id"](spark, docs, FOLDER)
    assert one.columns == docs.columns and {100, 101, 102}.isdisjoint(r.doc_id for r in one.collect())
    exact = stages["exact_dedup"](spark, docs, FOLDER)
    last = {}
    for i, t in ROWS:
        last[(t or "").translate(LOW)] = max(i, last.get((t or "").translate(LOW), -1))
    assert {r.doc_id for r in exact.collect()} == {*last.values()}
    near = stages["near_dedup"](spark, docs, FOLDER)
    assert {r.doc_id for r in near.collect()} == {i for i, (_, c) in brute_components(ROWS, 5).items() if i == c}
    cut = {r.doc_id: r for r in stages["substring_dedup"](spark, docs, FOLDER).collect()}
    for i, (_, removed, kept) in brute_removal(ROWS).items():
        assert cut[i].text == (kept if removed else dict(ROWS)[i])
    packed = stages["packing"](spark, docs, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {i for i, _ in ROWS}
    for name in list(stages)[:-1]:
        assert stages[name](spark, docs.limit(0), FOLDER).count() == 0


def say(k, n=40):
    return " ".join(f"w{(k * 7919 + j * 104729) % 1000003}x" for j in range(n))


EDGES = [
    (1, say(1)), (2, say(1).upper().replace("W", "w")), (2, say(2)), (2, say(2)), (3, None), (4, ""), (5, say(4)), (6, say(4) + " and one more"),
    (7, say(5, 3000)), (8, "tail " + say(1)), (None, say(3)), (None, say(3)), (None, None),
]


def test_edge_rows_of_the_stages(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing columns: what the docstrings say."""
    schema = "doc_id long, text string, lang string, source string, n_chars int, kept int, component_id int, rank int, n_removed int"
    docs = spark.createDataFrame([(i, t, None if i in (1, None) else "en", None, None, 7, 7, 7, 7) for i, t in EDGES], schema)
    text = {(i, t) for i, t in EDGES if t}
    stays = {
        "language_id": sorted(((i, t) for i, t in EDGES if t), key=str),
        "exact_dedup": sorted((text - {(1, say(1))} | {(2, EDGES[1][1]), (4, "")}), key=str),
        "near_dedup": sorted(((i, t) for i, t in EDGES if i not in (2, 6, 8)), key=str),
        "substring_dedup": sorted(((i, {6: "and one more", 8: "tail"}.get(i, t)) for i, t in EDGES), key=str),
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        rows = out.collect()
        assert out.columns == docs.columns and all((r.kept, r.component_id, r["rank"]) == (7, 7, 7) for r in rows), name
        assert sorted(((r.doc_id, r.text) for r in rows), key=str) == stays[name], name
    pieces = corpus_pipeline.packing(spark, docs, FOLDER).filter("start = 0").collect()
    assert sorted((r.doc_id for r in pieces), key=str) == sorted((i for i, _ in EDGES), key=str)


def test_queries_equal_their_sql(spark):
    for name, sql in ORACLE.items():
        assert spark_rows(QUERIES[name](spark, FOLDER)) == duck_rows(sql, FOLDER), name
