import random

import corpus_pipeline as P
from basketlab.llm.queries import ORACLES, QUERIES


def test_stage_list():
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "minhash", "suffix_dedup", "packing"]
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_planted_cases(spark, tmp_path):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    clean = [text(rng.randint(30, 120)) for _ in range(120)]
    docs = [(i, t) for i, t in enumerate(clean)]
    toxic = [(200 + i, text(20) + f" idiot {text(5)} scum " + text(20)) for i in range(60)]
    long = text(200).split()
    near = long[:100] + ["changed"] + long[101:]
    passage = text(60)
    docs += toxic + [(300, clean[4]), (301, clean[4].replace(" ", "  ", 1)), (310, " ".join(long)), (311, " ".join(near)),
                     (320, text(80) + " " + passage + " " + text(80)), (321, text(70) + " " + passage + " " + text(90)), (330, None)]
    # rows without an id, and rows that share the id of others, are decided by their own text
    odd = [(None, text(40)), (None, text(20) + " idiot scum " + text(20)), (3, text(12) + " idiot scum " + text(30)), (205, text(50)), (6, clean[7])]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs + odd]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i >= 200)) for i, _ in docs[:150]], "doc_id long, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    table, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    stays = {odd[0], odd[3]}
    for name, stage in P.STAGES[:-1]:
        out = str(tmp_path / name)
        stage(spark, table, str(tmp_path)).write.parquet(out)
        table = spark.read.parquet(out)
        assert table.columns == P.COLUMNS
        got = [(r.doc_id, r.text) for r in table.collect()]
        assert stays <= set(got) and not {odd[1], odd[2]} & set(got)
        assert ((7, clean[7]) in got) == (name == "toxicity") and odd[4] in got  # of equal texts the row of id 6 stays
        kept[name] = {i: t for i, t in got if (i, t) not in odd}
    everyone = {i for i, _ in docs}
    assert set(kept["toxicity"]) == everyone - {i for i, _ in toxic}
    assert set(kept["exact_dedup"]) == set(kept["toxicity"]) - {300, 301, 7}
    assert set(kept["minhash"]) == set(kept["exact_dedup"]) - {311}
    last = kept["suffix_dedup"]
    assert passage in last[320] and passage not in last[321] and len(last[321]) > 500
    assert set(last) == set(kept["minhash"]) - {330} | ({330} & set(last))
    assert all(last[i] == t for i, t in enumerate(clean) if i != 7)
    packed = P.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(last) | {None, 205}


def test_empty_table_and_further_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, key string"
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for rows, want in (([], []), ([(1, "a few words", "en", "s", 11, False, "k")], [1])):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in P.STAGES[:3]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == P.COLUMNS and [r.doc_id for r in docs.collect()] == want
