from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from eddyline.llm import packing, poisson_mix, quality_rules
from eddyline.llm.oracle import ORACLE
from eddyline.llm.queries import QUERIES
from eddyline.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tests.llm.test_line_dedup import expected as deduped
from tests.llm.test_near_duplicates import brute
from tests.llm.test_packing import check, pieces_of
from tools.check_oracle import digest


def test_stages_match_brute_force(spark, docs, rows, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept_rows = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = kept_rows or [tuple(r) for r in rows]
        source = spark.createDataFrame(before, docs.schema)
        out = stage(spark, source, str(tmp_path))
        assert out.columns == docs.columns
        kept_rows = [tuple(r) for r in out.collect()]
        if name == "quality_rules":
            good = quality_rules.query(source).where("kept").select("doc_id").collect()
            assert Counter(r[0] for r in kept_rows) == Counter(r[0] for r in good) and 0 < len(kept_rows) < len(rows)
        elif name == "line_dedup":
            assert Counter(r[:2] for r in kept_rows) == Counter(r[:2] for r in deduped(before))
            assert all(r[4] == len(r[1]) for r in kept_rows)
        elif name == "minhash_near_dedup":
            groups = {c for i, _, c in brute(before) if i is not None}
            assert sorted(r[0] for r in kept_rows if r[0] is not None) == sorted(groups)
        else:
            copies = poisson_mix.replicate(source, poisson_mix.WEIGHTS, shuffle=False).groupBy("doc_id").count().collect()
            assert Counter(r[0] for r in kept_rows) == Counter({r[0]: r[1] for r in copies})
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check(out, packing.CAPACITY)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == Counter(pieces_of(kept_rows))


def test_columns_of_the_input_are_handed_on(spark, docs, rows):
    """Columns called like an operator's measures, private names and helpers come out as they came in."""
    from pyspark.sql import functions as F

    names = ["n_words", "fail_bits", "KEPT", "n_lines", "n_dropped", "rate", "copies", "copy", "shuffle_key", "_text_hash", "_id_hash", "_parts",
             "_table", "component_id", "_in0", "_drop", "set_hash", "_source"]
    marked = docs.withColumns({n: F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in names})
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, marked, "")
        assert out.columns == marked.columns and out.dtypes == marked.dtypes
        got = out.collect()
        assert got and all(r[n] == f"{n}:{r['doc_id'] if r['doc_id'] is not None else '-'}" for r in got for n in names), name
        plain = stage(spark, docs, "").collect()
        assert Counter(tuple(r)[:5] for r in got) == Counter(map(tuple, plain)), name


def test_empty_table(spark, empty, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    a, b = digest(QUERIES[name](spark, SF_SMALL).toPandas()), digest(con.sql(ORACLE[name]).df())
    assert a[:3] == b[:3]
