import duckdb

from basketlab.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_exact_dedup_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(ORACLES["op2_exact_dedup"])
    got = QUERIES["op2_exact_dedup"](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_rows_and_columns(spark):
    n = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "pages")}
    want = {"op1_extraction": ("pages", ["page_id", "url", "text", "n_chars"]),
            "op4_warc": ("pages", ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]),
            "op7_toxicity": ("documents", ["doc_id", "toxic"]), "op8_minhash": ("documents", ["doc_id", "class_id", "kept"]),
            "op9_token_counts": ("documents", ["doc_id", "n_tokens"]),
            "op10_suffix_dedup": ("documents", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])}
    for name, (table, columns) in want.items():
        df = QUERIES[name](spark, SF)
        assert set(columns) <= set(df.columns) and df.count() == n[table], name
