"""The pipeline's stages take effect, and each keeps what it should; the registered corpus queries run."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from costlake.llm import queries

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with one case for each stage."""
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(3, 9))) for _ in range(900)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    docs, labels = [], []
    for i in range(400):
        text, bad = prose(rng.randint(60, 120)), i % 5 == 0
        if bad:
            own = text.split()
            for _ in range(5):
                own[rng.randrange(len(own))] = rng.choice(["idiot", "moron", "scum"])
            text = " ".join(own)
        docs.append((i, text, "en", "ab"[i % 2], len(text)))
        labels.append((i, 1, int(bad)))
    passage = prose(70)
    near = prose(200)
    docs += [(1000, "too short", "en", "a", 9), (1001, " ".join(w + "###" for w in prose(90).split()), "en", "a", 0),
             (1002, "you idiot " + prose(80) + " moron and scum", "en", "a", 0),
             (1003, near, "en", "a", len(near)), (1004, near.replace(near.split()[40], "swapped", 1), "en", "b", len(near)), (1005, near, "en", "b", len(near)),
             (1006, prose(60) + " " + passage + " " + prose(60), "en", "a", 0), (1007, prose(60) + " " + passage + " " + prose(60), "en", "a", 0),
             (1008, None, "en", "a", None), (1009, "", None, None, 0)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, docs, passage


def test_stages(spark, folder):
    path, given, passage = folder
    frame = spark.read.parquet(f"{path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "repeated_passages", "packing"]
    left = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, frame, path)
        if k < 4:
            assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out = f"{path}/out-{name}"
        frame.write.parquet(out)
        frame = spark.read.parquet(out)
        left[name] = frame.collect()
    ids = {name: {r.doc_id for r in rows} for name, rows in left.items()}
    texts = {d[0]: d[1] for d in given}
    assert {1000, 1001, 1008, 1009}.isdisjoint(ids["quality_rules"])
    assert {d[0] for d in given if d[0] < 1000 or 1002 <= d[0] <= 1007} == ids["quality_rules"]
    clean = {i for i in ids["quality_rules"] if not (i < 1000 and i % 5 == 0) and i != 1002}
    assert clean <= ids["quality_classifier"]
    assert len(ids["quality_classifier"] - clean) <= 4 and 1002 not in ids["quality_classifier"]
    assert ids["quality_classifier"] - ids["near_duplicates"] == {1004, 1005}
    assert ids["near_duplicates"] == ids["repeated_passages"]
    cleaned = {r.doc_id: r.text for r in left["repeated_passages"]}
    assert passage in cleaned[1006] and passage[10:-10] not in cleaned[1007]
    assert all(cleaned[i] == texts[i] for i in cleaned if i != 1007)
    assert ids["packing"] == ids["repeated_passages"]
    lengths = {}
    for r in left["packing"]:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert sorted(lengths.values())[1:] == [1024] * (len(lengths) - 1)


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder[0]).select("doc_id").distinct().count() > 300


def test_stages_on_an_empty_table(spark, folder, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert set(queries.ORACLE) <= set(queries.QUERIES)
