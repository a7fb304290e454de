"""The registered queries, and the pipeline against brute force stage by stage."""

import random
import sys

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from scripts_compare import normalise
from test_llm_operators import check_pieces, slow_groups
from townpull.llm import decontamination, toxicity

NAMES = ["op1_simhash", "op2_packing", "op3_token_counts", "op4_sharding", "op5_ann", "op6_substring_dedup",
         "op7_token_binary", "op8_url_filter", "op9_toxicity", "op10_decontamination", "pipeline"]
COLUMNS = {
    "op1_simhash": ["doc_id", "fingerprint", "component_id"],
    "op2_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op3_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op4_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op5_ann": ["query_id", "rank", "vec_id", "score"],
    "op7_token_binary": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op8_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op9_toxicity": ["doc_id", "held_out", "score", "predicted"],
}


def test_all_are_registered():
    assert set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_columns(spark, name):
    assert E.queries()[name](spark, SF_SMALL).columns == COLUMNS[name]


def test_url_filter_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = normalise(E.queries()["op8_url_filter"](spark, SF_SMALL).toPandas())
    want = normalise(con.execute(E.oracle_sql()["op8_url_filter"]).df())
    assert len(got) == len(want) and (got.values == want.values).all()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with small documents, labels and benchmark tables, and what was planted."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(3000)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [text(rng.randint(15, 50)) for _ in range(20)]
    passage = text(90)
    docs, labels, plant = [], [], {"toxic": set(), "copies": {}, "passage": [], "leaks": set(), "words": " ".join(passage.split(" ")[30:60])}
    for d in range(500):
        t = "\n".join(text(rng.randint(25, 60)) for _ in range(3))
        kind = rng.random()
        if kind < 0.25:
            w = t.split(" ")
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["scumzz", "trashzz", "idiotzz"]))
            t = " ".join(w)
            plant["toxic"].add(d)
        elif kind < 0.35 and docs:
            of = rng.choice([x for x in range(d) if x not in plant["toxic"]])
            t = docs[of][1]
            plant["copies"][d] = of
        elif kind < 0.42:
            w = t.split(" ")
            at = rng.randrange(5, 20)
            t = " ".join(w[:at] + passage.split(" ") + w[at:])
            plant["passage"].append(d)
        elif kind < 0.5:
            t = t + " " + rng.choice(items) + "\n" + text(10)
            plant["leaks"].add(d)
        docs.append((d, t, "en", "s", len(t)))
        labels.append((d, 1, int(d in plant["toxic"])))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, plant, items


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_pipeline_stage_by_stage(spark, corpus, tmp_path):
    from tokenizers import Tokenizer

    import public_tokenizers
    folder, plant, items = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    after = {}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        before = docs
        step(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns

    before, kept = after["toxicity"]
    model = toxicity.train(before, spark.read.parquet(f"{folder}/labels.parquet"))
    place = dict(zip(model.features, model.weights))
    clean = [(d, t) for d, t in rows_of(before)
             if 1 / (1 + np.exp(-(sum(place.get(int(g), 0.0) for g in set(toxicity.grams(t).tolist())) + model.intercept))) < 0.3]
    assert sorted(rows_of(kept)) == sorted(clean)
    ids = {d for d, _ in clean}
    assert len(ids & plant["toxic"]) <= 0.05 * len(plant["toxic"])
    assert len(ids - plant["toxic"]) >= 0.98 * (500 - len(plant["toxic"]))

    before, kept = after["simhash_near_dedup"]
    rows = rows_of(before)
    assert sorted(rows_of(kept)) == sorted((d, t) for d, t in rows if d in {c for _, _, c in slow_groups(rows)})

    before, kept = after["substring_dedup"]
    old, new = dict(rows_of(before)), dict(rows_of(kept))
    with_passage = sorted(d for d in plant["passage"] if d in old)
    changed = {d for d in old if new.get(d) != old[d]}
    # a benchmark item that several documents hold is a repeated passage, too
    assert set(with_passage[1:]) <= changed <= set(with_passage[1:]) | plant["leaks"]
    assert sum(t.count(plant["words"]) for t in new.values()) == 1

    before, kept = after["benchmark_decontamination"]
    rows = rows_of(before)
    found = {d for d, _ in decontamination.brute_force_leaks(rows, list(enumerate(items)))}
    assert sorted(rows_of(kept)) == sorted(r for r in rows if r[0] not in found)
    assert {d for d, t in rows if any(" ".join(i.split()) in " ".join(t.split()) for i in items)} <= found
    assert found and found <= plant["leaks"] | set(plant["copies"])

    before, packed = after["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert check_pieces(rows_of(before), packed.collect(), library) > 0.85


def test_run_is_the_chain_of_stages(spark, corpus):
    folder, _, _ = corpus
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == COLUMNS["op2_packing"] and got.count() > 200


def test_the_rest_works_without_these(spark):
    """Nothing else in the package imports the subpackage."""
    import os
    import re
    root = os.path.dirname(sys.modules["townpull"].__file__)
    for d, _, files in os.walk(root):
        if os.path.basename(d) != "llm":
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(d, f)) as fh:
                        assert not re.search(r"townpull\.llm|corpus_pipeline", fh.read()), f
