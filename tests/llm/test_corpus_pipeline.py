import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from qmeasures.llm import packing, simhash

PARTS = {"en": ["the", "ing", "and", "er", "ion", "sh"], "de": ["sch", "ung", "keit", "ein", "pf", "ö"]}
SCHEMA = "text string, doc_id long, extra string, lang string, row long, rejected string, source string, n_chars long"


def sentence(rng, lang, n):
    return " ".join("".join(rng.choices(PARTS[lang], k=rng.randint(1, 3))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, rows = random.Random(6), []
    for i in range(300):
        lang = "en" if i % 3 else "de"
        rows.append((" ".join(sentence(rng, lang, rng.randint(4, 12)) for _ in range(rng.randint(1, 8))), i, "e", lang, 1, "x", "s", 1))
    clean = {r[1] for r in rows}
    rows += [(rows[5][0], 1000 + k, None, None, None, None, None, None) for k in range(3)]   # copies of 5
    rows.append((rows[7][0].swapcase(), 7, None, "en", None, None, None, None))                  # the same id, equal fingerprint
    junk = [" ".join(w.upper() + "###!!" for w in r[0].split()) for r in rows[:20] if len(r[0]) > 60]
    rows += [(t, 2000 + k, "j", "en", 2, "y", "s", 2) for k, t in enumerate(junk)]
    rows += [(None, 3000, None, None, None, None, None, None), ("", 3001, None, "en", 0, "", "", 0), ("12 34 !", 3002, "", "de", 0, "", "", 0),
             (" ".join(sentence(rng, "en", 10) for _ in range(3000)), 4000, "", "en", 0, "", "", 0), (sentence(rng, "en", 30), None, "", "en", 0, "", "", 0)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    marks = [(i, 1, 0) for i in range(0, 300, 2)] + [(2000 + k, 0, 0) for k in range(4)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, clean, len(junk)


def test_stages(spark, tables):
    path, rows, clean, n_junk = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen, path)
        assert out.schema.simpleString() == docs.schema.simpleString()
        got = [tuple(r) for r in out.collect()]
        assert len(got) == len(set(got)) and set(got) <= set(rows)
        seen = spark.createDataFrame(got, docs.schema)
        kept[name] = got
    language, quality, unique = kept.values()
    ids = {r[1] for r in language}
    assert clean <= ids and not ids & {3000, 3001, 3002} and len(language) == len(rows) - 3
    ids = {r[1] for r in quality}
    assert len(clean - ids) <= 3 and sum(2000 + k in ids for k in range(n_junk)) == 0 and 4000 in ids and None in ids
    prints = {}
    for r in quality:
        prints.setdefault(simhash.fingerprint((r[0] or "").encode()), []).append(r)
    own = {r[1] for r in unique}
    assert 5 in own and not own & {1000, 1001, 1002} and sum(r[1] == 7 for r in unique) == 1
    assert len(unique) <= len(prints)
    for a in unique:
        for b in unique:
            if a is not b:
                pa, pb = (simhash.fingerprint((x[0] or "").encode()) for x in (a, b))
                assert (pa ^ pb).bit_count() > 2


def test_run_packs_what_is_left(spark, tables):
    path, rows, _, _ = tables
    got = corpus_pipeline.run(spark, path).collect()
    texts = {}
    for r in rows:
        texts.setdefault(r[1], set()).add(len((r[0] or "").split()))
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    assert all(n in texts[i] for i, n in total.items()) and len(total) > 290
    assert {r.seq_length for r in got} <= {*packing.LENGTHS}


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    assert corpus_pipeline.run(spark, path).select(F.count("*")).first()[0] == 0
