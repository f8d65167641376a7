"""Stages of the pipeline against plain versions, with planted cases among the given documents."""

import re

import pytest
from pyspark.sql import functions as F
from test_operators import awkward, plain_fingerprint, plain_groups, plain_removal

import corpus_pipeline
from tributary.llm.queries import PIECE_MODEL

PASSAGE = " ".join(f"Lantern{k} over{k % 7} harbour{k * 3}" for k in range(25))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The small tables with planted documents, ids from 9000 on."""
    folder = str(tmp_path_factory.mktemp("tables"))
    source = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{source}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    item = spark.read.parquet(f"{source}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = " ".join(f"calm{k} river{k * k}" for k in range(120))
    planted = {
        9000: clean, 9001: clean, 9002: clean.replace("calm7 ", "calmer7 "),
        9003: " ".join(f"first{k}" for k in range(60)) + " " + item, 9004: " ".join(f"quiet{k} hill{k}" for k in range(80)),
        9005: PASSAGE + " " + " ".join(f"left{k}" for k in range(70)), 9006: " ".join(f"right{k}" for k in range(70)) + " " + PASSAGE,
        9007: "you worthless idiot and moron, pathetic scum " * 3 + " ".join(f"word{k}" for k in range(20)),
    }
    rows = [(i, t, "en", "planted", len(t)) for i, t in planted.items()]
    extra = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.select(extra.columns).unionByName(extra).repartition(4).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.fixture(scope="module")
def kept(spark, tables):
    """Rows after each stage, by id."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = [{r["doc_id"]: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, tables), name)
        out.append({r["doc_id"]: r for r in docs.collect()})
    return out


def test_columns(kept):
    for rows in kept[:-1]:
        assert set(next(iter(rows.values())).asDict()) == set(corpus_pipeline.COLUMNS)


def test_toxic_documents_go(kept):
    assert set(kept[0]) - set(kept[1]) >= {9007} and {9000, 9003, 9004, 9005, 9006} <= set(kept[1])
    assert len(kept[1]) > 0.85 * len(kept[0])


def test_one_of_each_group_of_near_copies_stays(kept):
    """Groups by all pairs of fingerprints, four words a shingle and at most 4 of 64 bits apart."""
    before, after = kept[1], kept[2]
    assert {9000, 9001, 9002} & set(after) == {9000} and 9004 in after
    groups = plain_groups({i: (plain_fingerprint(r["text"], 4),) for i, r in before.items()}, 4)
    assert set(after) == set(groups.values())


def test_repeated_passages_are_cut(kept):
    before, after = kept[2], kept[3]
    assert set(before) == set(after)
    plain = plain_removal([(i, r["text"]) for i, r in before.items()])
    for i, r in after.items():
        if plain[i][1] == 0:
            assert r["text"] == before[i]["text"]
        else:
            assert len(r["text"].encode()) <= plain[i][0] - plain[i][1] and "�" not in r["text"]
        assert r["n_chars"] == len(r["text"])
    assert PASSAGE in after[9005]["text"] and PASSAGE not in after[9006]["text"]
    assert after[9006]["text"].startswith("right0 ")


def test_contaminated_documents_go(spark, tables, kept):
    def words(text):
        return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))

    windows = set()
    for row in spark.read.parquet(f"{tables}/benchmark.parquet").collect():
        own = words(row["text"])
        windows |= {tuple(own[i : i + 10]) for i in range(max(1, len(own) - 9))} if own else set()
    clean = set()
    for i, r in kept[3].items():
        own = words(r["text"])
        if not any(tuple(own[k : k + 10]) in windows for k in range(max(1, len(own) - 9))):
            clean.add(i)
    assert set(kept[4]) == clean and 9003 not in clean and 9004 in clean


def test_tokens_are_the_librarys(kept):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    assert set(kept[5]) == set(kept[4])
    for i, r in kept[5].items():
        assert r["token_ids"] == library.encode(kept[4][i]["text"]) and r["n_tokens"] == len(r["token_ids"])


def test_run_gives_the_last_stage(spark, tables, kept):
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, tables).collect()}
    assert found == kept[5]


def test_awkward_and_empty_tables(spark, tables, tmp_path):
    docs = awkward(spark)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for folder, rows in ((tables, docs), (str(tmp_path), docs), (tables, docs.limit(0))):
        for name, stage in corpus_pipeline.STAGES:
            rows = corpus_pipeline.stored(stage(spark, rows, folder), name)
            rows.count()


def test_last_stage_decodes(kept):
    assert kept[5] and all(r["round_trip"] is True for r in kept[5].values())
