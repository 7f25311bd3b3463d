"""The queries on the smallest tables, against SQL where there is some; the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillgraph.llm import langid, simhash
from quillgraph.llm.common import table
from quillgraph.llm.queries import ORACLES, QUERIES
from tests.compare import duck, same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        same(df, duck(SF), ORACLES[name])
    else:
        assert df.count() > 0


def test_registered():
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        new = stage(spark, docs, SF).persist()
        if name != "bpe":
            assert new.columns == docs.columns
        seen[name] = (docs, new)
        docs = new
    before, after = seen["near_duplicates"]
    firsts = {r["doc_id"] for r in simhash.similar(before).collect() if r["doc_id"] == r["component_id"]}
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == firsts
    assert seen["language"][1].count() >= 0.95 * seen["language"][0].count()
    assert seen["bpe"][1].count() == seen["mixing"][1].count()
    assert langid.UNDETERMINED not in {r["lang"] for r in seen["bpe"][1].select("lang").distinct().collect()}


def test_clashing_columns(spark):
    """Columns that bear any name used inside change no stage's rows."""
    names = "row text_ score offending lang_pred key k f g fp n total node u v h a b root least_id component_id first_id anchor part parts visits size rate number target source_size goal_source salt goal_salt copies copy weight most rank by y df bucket ids decoded label toxic count __score __text __n".split()
    docs = table(spark, SF, "documents").limit(60)
    wide = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES:
        plain, odd = stage(spark, docs, SF), stage(spark, wide, SF)
        if name == "bpe":
            assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, odd.collect()))
            break
        assert odd.columns == wide.columns
        got = odd.collect()
        assert sorted(str(tuple(r)) for r in plain.collect()) == sorted(str(tuple(r[: len(docs.columns)])) for r in got)
        assert all(r[n] == f"{n}{r['doc_id']}" for r in got for n in names)
        docs = docs.sparkSession.createDataFrame(plain.collect(), docs.schema)
        wide = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, "", "en", None, 0), (1, "", "en", None, 0), (2, "The text of it.", None, "s", 15)]])
def test_pipeline_on_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).persist()
        docs.count()
