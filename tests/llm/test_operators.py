"""Operators against plain versions, on small and on awkward tables."""

import hashlib
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tributary.llm import fill_in_middle as fim, fingerprints, licences, quality, sharding, simhash, spelling, suffix_dedup, top_k, toxicity, url_filters
from tributary.llm.common import components
from tributary.llm.decontamination import decontaminate
from tributary.llm.pieces import Encoder, Model, decode, decode_tokens, encode
from tributary.llm.queries import PIECE_MODEL, QUERIES
from tributary.llm.suffix_dedup import remove_repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, node long, tokens string, start int"
LINE = "Every harbour keeps a lantern burning for the last ship of the evening tide. "


def awkward(spark):
    """Nulls, blanks, ties, repeated rows, a very long text, and columns with the operators' own names."""
    words = [f"w{i % 977}" for i in range(60_000)]
    texts = [
        (1, LINE * 4), (2, LINE * 4), (3, "x " + LINE * 4), (4, ""), (5, None), (6, " \n\t "), (7, "one"),
        (8, " ".join(words)), (9, " ".join(words[:-1]) + " end"), (10, "Grüße an ÄÖÜ 日本 ▁ �"), (11, "a" * 5000), (11, "a" * 5000),
        (None, "text without id " + LINE), (12, "Released under the MIT License."),
    ]
    rows = [(i, t, None if i == 2 else "en", "s", None, 5, 6, "clash", 7) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=((1, 1, 0), (2, 0, 1), (3, None, None), (99, 1, 1), (1, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def texts_of(spark, sf, count=None):
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows[:count]]


# -- 1 ---------------------------------------------------------------------------------------------------


def plain_fingerprint(text, width, seed=42):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed) for s in shingles]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(prints, radius):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sum((x ^ y).bit_count() for x, y in zip(prints[a], prints[b])) <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_query_equals_all_pairs(spark, sf):
    found = {r["doc_id"]: r for r in QUERIES["op1_simhash_near_dedup"](spark, sf).collect()}
    prints = {i: (plain_fingerprint(t, 4),) for i, t in texts_of(spark, sf)}
    groups = plain_groups(prints, 4)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in found.items()} == {
        i: (f"{prints[i][0]:016x}", groups[i]) for i in prints
    }


def test_spark_hash_is_the_fingerprint_hash(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("grüße an alle")).alias("h")).first()
    assert row["h"] % 2**64 == xxhash.xxh64_intdigest("grüße an alle".encode(), 42)


@pytest.mark.parametrize("lanes, radius, tile, block", [(1, 4, 3, 2), (1, 4, 8192, 500_000), (2, 25, 4, 3), (1, 0, 8192, 1)])
def test_links_of_small_tiles_equal_all_pairs(spark, lanes, radius, tile, block):
    rng = random.Random(lanes * 100 + radius)
    prints = {}
    for i in range(60):
        base = prints[rng.randrange(i)] if i and rng.random() < 0.6 else tuple(rng.getrandbits(64) for _ in range(lanes))
        flips = [rng.randrange(64) for _ in range(rng.randrange(4))]
        prints[i] = tuple(v ^ sum(1 << f for f in set(flips)) for v in base)
    distinct = {p: i for i, p in reversed(prints.items())}
    names = simhash.lane_names(lanes)
    signed = [(i, *(int(np.uint64(v).astype(np.int64)) for v in p)) for p, i in distinct.items()]
    rows = spark.createDataFrame(signed, "node long, " + ", ".join(f"{n} long" for n in names))
    found = components(simhash.links(rows, lanes=lanes, radius=radius, tile=tile, block=block))
    roots = {r["node"]: r["root"] for r in found.collect()}
    expected = plain_groups({i: p for p, i in distinct.items()}, radius)
    assert {i: roots.get(i, i) for i in expected} == expected


def test_components_of_paths_stars_and_nothing(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 260)]
    links = spark.createDataFrame(path + star + [(9, 9)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    assert roots == {**{i: 100 for i in range(100, 141)}, 7: 7, **{i: 7 for i in range(200, 260)}}
    assert components(links.limit(0)).count() == 0


def test_simhash_on_awkward_tables(spark):
    rows = simhash.near_duplicates(awkward(spark)).collect()
    group = {r["id"]: r["component"] for r in rows}
    assert len(rows) == 14 and group[2] == 1 and group[4] == group[5] == group[6] == 4 and group[9] == 8
    assert simhash.near_duplicates(empty(spark)).count() == 0


# -- 2 ---------------------------------------------------------------------------------------------------


def test_toxicity_finds_held_out_toxic_documents(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    documents, marks = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    model = toxicity.fit(documents, marks.where(~held))
    assert model.thresholds == sorted(model.thresholds)
    rows = toxicity.score(documents, model).join(marks.where(held).withColumnRenamed("toxic", "label"), marks.doc_id == F.col("id"))
    rows = [(r["toxic"], r["label"], r["severity"]) for r in rows.collect()]
    assert sum(t for t, label, _ in rows if label == 0) <= 0.02 * len(rows)
    toxic = [t for t, label, _ in rows if label == 1]
    assert sum(toxic) >= 0.5 * len(toxic)
    assert np.mean([s for _, label, s in rows if label == 1]) > 5 * np.mean([s for _, label, s in rows if label == 0])


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(3)
    rows = [sorted(set(rng.integers(0, 6, 3).tolist())) for _ in range(600)]
    strength = np.array([2.0, 1.0, 0.0, 0.0, -1.0, -2.0])
    margin = np.array([strength[r].sum() for r in rows]) + rng.logistic(size=600) * 0.3
    grades = np.digitize(margin, [-1, 0, 1.5])
    weights, cuts = toxicity.fit_ordinal(rows, grades, np.ones(600), 6)
    assert (np.diff(cuts) > 0).all() and weights[0] > weights[1] > weights[4] > weights[5]


def test_toxicity_on_awkward_tables(spark):
    model = toxicity.fit(awkward(spark), labels(spark))
    rows = toxicity.score(awkward(spark), model, keep=("text", "tokens")).collect()
    assert len(rows) == 14 and all(0 <= r["severity"] <= 3 for r in rows)
    nothing = toxicity.fit(empty(spark), labels(spark, [(1, 1, None)]))
    assert nothing.thresholds == []
    assert {(r["severity"], r["toxic"]) for r in toxicity.score(awkward(spark), nothing).collect()} == {(0.0, False)}
    assert toxicity.score(empty(spark), model).count() == 0


# -- 3 ---------------------------------------------------------------------------------------------------


def plain_removal(documents, length=50):
    """(n_bytes, n_removed, n_spans, kept) by comparing all strings."""
    first = {}
    data = [(i, (t or "").encode()) for i, t in documents]
    for i, text in sorted(data, key=lambda row: row[0]):
        for p in range(len(text) - length + 1):
            first.setdefault(text[p : p + length], i)
    out = {}
    for i, text in data:
        gone = bytearray(len(text))
        for p in range(len(text) - length + 1):
            if first[text[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(1 for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1]))
        out[i] = (len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_equals_all_strings(spark, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab é\n") for _ in range(500)) for _ in range(3)] + ["ab" * 120, LINE * 3]
    documents = []
    for i in range(80):
        parts = []
        for _ in range(rng.randrange(5)):
            source, start = rng.choice(pool), rng.randrange(300)
            parts += [source[start : start + rng.randrange(10, 150)], "".join(rng.choice("xyz") for _ in range(rng.randrange(40)))]
        documents.append((i * 3, "".join(parts)))
    rng.shuffle(documents)
    rows = spark.createDataFrame(documents, "doc_id long, text string").repartition(5)
    found = {r["doc"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(rows).collect()}
    assert found == plain_removal(documents)


def test_suffix_dedup_of_a_trigger_beyond_the_bound():
    from tributary.llm.suffix_dedup import first_documents

    data = [f"{n:04d}".encode() + LINE.encode()[:70] for n in range(30)]
    doc, run = np.arange(30), np.full(30, len(data[0]) - 49)
    whole = set(zip(*(v.tolist() for v in first_documents(data, doc, run, 50))))
    shares = [set(zip(*(v.tolist() for v in first_documents(data, doc, run, 50, share, 4)))) for share in range(4)]
    assert set().union(*shares) == whole and sum(map(len, shares)) == len(whole) == run.sum()


def test_suffix_dedup_sends_few_bytes_a_phrase():
    """Places of phrases, in byte planes, compress to about their telling bytes (14 bytes a phrase plain)."""
    import pyarrow as pa

    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(3000)) for _ in range(300)]
    ids = [rng.randrange(50_000) for _ in texts]
    batch = pa.RecordBatch.from_pydict({"doc": ids, "text": texts})
    rows = list(suffix_dedup._parser(50, 16)(iter([batch])))
    columns = ["doc", "start", "run"]
    count = sum(len(data) for row in rows for data in row.column("run").to_pylist()) // 2
    packed = sum(len(pa.compress(data, "lz4", asbytes=True)) for row in rows for name in columns for data in row.column(name).to_pylist())
    assert packed < 9 * count
    for kind, values in ((np.int64, [-(1 << 63), -1, 0, 7, (1 << 63) - 1]), (np.int32, [5, 1 << 30]), (np.int16, [49])):
        values = np.array(values, kind)
        assert (suffix_dedup._from_planes(suffix_dedup._planes(values), kind) == values).all()


def test_suffix_dedup_shuffles_packed_texts_once(spark):
    """Texts go through the shuffle compressed, spans as one number each."""
    import pyarrow as pa

    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(300)) for _ in range(40)] + [None, "", "é\u0000x"]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(len(texts))), "text": texts})
    sent = [data for row in suffix_dedup._packer(iter([batch])) for data in row.column(1).to_pylist()]
    assert [suffix_dedup.unpacked(data, pa.Codec("zstd")).decode() for data in sent] == [text or "" for text in texts]
    assert sum(map(len, sent)) < 0.6 * sum(len(text or "") for text in texts)
    start, run, hot = np.array([0, 7, (1 << 31) - 1]), np.array([1, 31, (1 << 15) - 1]), np.array([False, True, True])
    assert [v.tolist() for v in suffix_dedup._parts_of(suffix_dedup._place(start, run, hot))] == [v.tolist() for v in (start, run, hot)]
    texts += [texts[0][50:900] + texts[1][7:300], texts[1][40:200] + texts[0][300:700]]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for keep in ((), ("text",)):
            result = remove_repeats(made, keep=keep)
            assert len(result.collect()) == len(texts)
            plan = result._jdf.queryExecution().executedPlan().toString()
            assert "ReusedExchange" in plan and ("_packer" in plan) == (not keep)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_suffix_dedup_on_awkward_tables(spark):
    rows = remove_repeats(awkward(spark), keep=("text", "start")).collect()
    found = {(r["doc"], r["n_bytes"]): r["n_removed"] for r in rows}
    assert len(rows) == 14
    assert found[1, len(LINE) * 4] == 0 and found[2, len(LINE) * 4] == len(LINE) * 4 and found[11, 5000] == 0
    assert found[5, 0] == found[4, 0] == 0 and found[9, len(" ".join(f"w{i % 977}" for i in range(59_999))) + 4] > 200_000
    assert remove_repeats(empty(spark)).count() == 0


# -- 4 ---------------------------------------------------------------------------------------------------


def test_licence_frequencies_are_those_of_all_words(spark):
    """A header in ordinary words: their frequencies are counted like those of the templates' words."""
    header = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
    ordinary = "you may not use this file except in compliance with all that is written here"
    files = [(f"src/{k}.py", ordinary + f" {k}") for k in range(999)] + [("src/main.py", "import os\n" + header)]
    terms = {path: set(licences._terms_here(text)) for path, text in files}
    having = Counter(term for own in terms.values() for term in own)
    idf = {term: licences.inverse_frequency(len(files), n) for term, n in having.items()}
    statement = licences._terms_here(dict(licences.TEMPLATES)["Apache-2.0"])
    line = licences._terms_here(header)
    sizes = [sum((n * idf[t]) ** 2 for t, n in own.items()) ** 0.5 for own in (statement, line)]
    cosine = sum(n * line[t] * idf[t] ** 2 for t, n in statement.items()) / (sizes[0] * sizes[1])
    rows = spark.createDataFrame(files, "path string, text string")
    found = {r["path"]: r for r in licences.scan(rows).collect()}["src/main.py"]
    assert found["licence"] == "Apache-2.0" and found["basis"] == "own" and abs(found["cosine"] - cosine) < 1e-4


def test_licences_are_found_and_inherited(spark):
    files = [
        ("LICENSE", "Released under the MIT License."), ("a/b/c.py", "import os\nrun()"),
        ("a/COPYING", "This work is licensed under the\nGNU General Public License, version 3."),
        ("a/d.py", "# Licensed under the Apache License, Version 2.0.\nrun()"), ("z.py", None), ("e/f/g", "the work is under the version"),
        (None, "Released under the MIT License."),
    ]
    rows = spark.createDataFrame([(p, t, "x") for p, t in files], "path string, text string, licence string")
    found = {r["path"]: (r["licence"], r["basis"], r["origin"]) for r in licences.scan(rows).collect()}
    assert found["a/b/c.py"] == ("GPL-3.0", "inherited", "a/COPYING")
    assert found["a/d.py"] == ("Apache-2.0", "own", "a/d.py")
    assert found["z.py"] == found["e/f/g"] == ("MIT", "inherited", "LICENSE")
    assert found[None] == (None, "none", None) and len(found) == len(files)
    assert licences.scan(rows.limit(0)).count() == 0


def test_telling_terms_lose_no_line():
    idf = {t: 1.0 + len(t) % 4 for _, text in licences.TEMPLATES for t in licences._terms_here(text)}
    for threshold in (0.3, 0.6, 0.9):
        vectors = licences.template_weights(licences.TEMPLATES, idf)
        telling = set(licences.telling_terms(vectors, threshold))
        for vector in vectors:
            assert sum(w * w for t, w in vector.items() if t not in telling) < threshold**2


# -- 5 ---------------------------------------------------------------------------------------------------


def plain_capacity(sizes, shards):
    def fits(capacity):
        used, room = 1, capacity
        for size in sizes:
            if size > capacity:
                return False
            if size > room:
                used, room = used + 1, capacity
            room -= size
        return used <= shards

    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def plain_floor(sizes, shards, capacity):
    """Largest smallest part over all contiguous partitions within the capacity."""
    totals = np.concatenate(([0], np.cumsum(sizes)))
    best = {0: totals[-1]}
    for left in range(shards, 0, -1):
        after = {}
        for at, floor in best.items():
            for end in range(at, len(totals)):
                part = totals[end] - totals[at]
                if part <= capacity and (left > 1 or end == len(sizes)):
                    after[end] = max(after.get(end, -1), min(floor, part))
        best = after
    return best[len(sizes)]


@pytest.mark.parametrize("few", [200_000, 0])
def test_sharding_is_smallest_and_whole(spark, monkeypatch, few):
    monkeypatch.setattr(sharding.smallest_cuts, "__kwdefaults__", {"candidates": 5, "few": few})
    rng = random.Random(few)
    texts = ["x" * rng.randrange(400) for _ in range(90)] + ["hot" * 700] * 40 + [None, "", ""]
    documents = list(enumerate(texts))
    rows = spark.createDataFrame(documents, "doc_id long, text string").repartition(4)
    found = sharding.shard(rows, shards=7).collect()
    groups: dict = {}
    for i, text in documents:
        first, size = groups.get(text or "", (i, 0))
        groups[text or ""] = (first, size + len(text or "") + 8)
    load = [0] * 7
    for r in found:
        load[r["shard"]] += r["size"]
    sizes = [size for _, size in sorted(groups.values())]
    assert max(load) == plain_capacity(sizes, 7) and min(load) == plain_floor(sizes, 7, max(load))
    by_text: dict = {}
    for r in found:
        by_text.setdefault(texts[r["id"]] or "", set()).add(r["shard"])
        assert r["text_crc32"] == crc32((texts[r["id"]] or "").encode()) and r["size"] == len(texts[r["id"]] or "") + 8
    assert all(len(s) == 1 for s in by_text.values())
    for shard in range(7):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_sharding_on_awkward_tables(spark):
    rows = sharding.shard(awkward(spark)).collect()
    assert len(rows) == 14 and len({(r["shard"], r["slot"]) for r in rows}) == 14
    assert sharding.shard(empty(spark)).count() == 0


# -- 6 ---------------------------------------------------------------------------------------------------


def plain_hashes(text, width=5):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = text.translate(fold).encode().split()
    shingles = {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
    return {(xxhash.xxh64_intdigest(s, 42) + 2**63) % 2**64 - 2**63 for s in shingles}


def plain_sketch(hashes, least):
    halvings = max(k for k in range(4) if k == 0 or len(hashes) >= least << k)
    return halvings, {h for h in hashes if halvings == 0 or h < -(2**63) + 2 ** (64 - halvings)}


def alike(a, b):
    return len(a & b) / len(a) if a else float(not b)


@pytest.mark.parametrize("block, least", [(4 << 20, 256), (3000, 8)])
def test_fingerprints_equal_plain_sketches(spark, sf, block, least):
    documents = texts_of(spark, sf, 60) + [(1000, None), (1001, ""), (1002, "kürzer")]
    rows = spark.createDataFrame(documents, "doc_id long, text string").repartition(4)
    found = {r["id"]: r for r in fingerprints.edited_fingerprints(rows, bytes_per_block=block, least=least).collect()}
    order = sorted(documents, reverse=True)
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after, r = text or "", after or "", found[i]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        (level, own), (other_level, other) = (plain_sketch(plain_hashes(t), least) for t in (text, edited))
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == f"{level}:" + "".join(f"{h % 2**64:016x}" for h in sorted(own))
        assert r["edited_fingerprint"] == f"{other_level}:" + "".join(f"{h % 2**64:016x}" for h in sorted(other))
        assert (r["near_edited"], r["near_next"]) == (alike(own, plain_hashes(edited)), alike(own, plain_hashes(after)))


def test_likeness_is_close_to_true_containment(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    documents = texts_of(spark, folder)
    found = {r["doc_id"]: r for r in QUERIES["op6_document_fingerprints"](spark, folder).collect()}
    order, errors = sorted(documents, reverse=True), []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        third = len(text) // 3
        own = plain_hashes(text)
        errors.append(abs(found[i]["near_edited"] - alike(own, plain_hashes(text[: len(text) - third] + after[:third]))))
        errors.append(abs(found[i]["near_next"] - alike(own, plain_hashes(after))))
    assert np.mean(errors) < 0.01 and max(errors) < 0.15


def test_a_short_text_inside_a_long_one(spark):
    long = " ".join(f"word{k}" for k in range(20_000))
    rows = spark.createDataFrame([(2, "word77 word78 word79 word80 word81 word82"), (1, long)], "doc_id long, text string")
    found = {r["id"]: r for r in fingerprints.edited_fingerprints(rows).collect()}
    assert found[2]["near_next"] == 1.0 and found[1]["near_next"] < 0.01
    assert found[1]["fingerprint"].startswith("3:") and found[2]["fingerprint"].startswith("0:")
    whole = rows.select("doc_id", fingerprints.sketch(F.col("text")).alias("s"))
    pair = whole.where("doc_id = 2").select(F.col("s").alias("a")).crossJoin(whole.where("doc_id = 1").select(F.col("s").alias("b")))
    told = pair.select(fingerprints.containment(F.col("a"), F.col("b")).alias("x"), fingerprints.containment(F.col("b"), F.col("a")).alias("y")).first()
    assert told["x"] in (None, 1.0) and told["y"] < 0.01


def test_sketches_merge(spark, sf):
    documents = spark.createDataFrame([(i % 2, t) for i, t in texts_of(spark, sf, 10)] + [(2, None)], "part int, text string")
    single = documents.select("part", fingerprints.sketch(F.coalesce("text", F.lit("")), least=16).alias("sketch"))
    merged = {r["part"]: r["sketch"] for r in fingerprints.merged(single, ["part"]).collect()}
    for part in (0, 1, 2):
        texts = [r["text"] or "" for r in documents.where(F.col("part") == part).collect()]
        level = max(plain_sketch(plain_hashes(t), 16)[0] for t in texts)
        union = set().union(*map(plain_hashes, texts))
        assert (merged[part]["halvings"], merged[part]["hashes"]) == (level, sorted(h for h in union if level == 0 or h < -(2**63) + 2 ** (64 - level)))


def test_fingerprints_on_awkward_tables(spark):
    rows = fingerprints.edited_fingerprints(awkward(spark)).collect()
    assert len(rows) == 14 and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert fingerprints.edited_fingerprints(empty(spark)).count() == 0


# -- 7 ---------------------------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, trust int")


def test_distrust_reaches_the_end_of_a_chain(spark):
    """Thirty hosts in a row, the last of which points at a blocked one: however far, all are blocked."""
    rows = [(k, f"https://h{k}.com/x", f'<a href="https://h{k - 1}.com/x">l</a>', "", 0) for k in range(1, 31)]
    rows += [(0, "https://h0.com/x", '<a href="http://spam.net/">s</a>', "", 0), (99, "http://spam.net/", "", "", 0), (98, "https://calm.com/", "", "", 0)]
    found = {r["id"]: r["verdict"] for r in url_filters.judge(pages(spark, rows)).collect()}
    assert {i for i, verdict in found.items() if verdict == "allow"} == {98}


def test_trust_and_distrust_flow(spark):
    good, bad = "https://www.france.org/fr/1", "http://spam.net/x"
    rows = [
        (1, good, '<a href="https://friend.com/x">f</a><a href="/own">o</a>', "", 0),
        (2, "https://friend.com/x", '<a href="//other.com">x</a>', "", 0),
        (3, "https://shill.com/a", f"<a href='{bad}'>b</a>", "", 0),
        (4, bad, "", "", 0), (5, "HTTP://Shill.COM?q", None, "", 0), (6, None, "<p>", "", 0), (7, "no-scheme.net/x", "", "", 0),
        (8, "https://sub.example.net/en/a?b", "", "", 0), (9, "https://example.net/de", "", "", 0), (10, "http://net/", "", "", 0),
        (11, "http://notnet", "", "", 0), (11, "http://notnet", "", "", 0),
    ]
    found = {r["id"]: r for r in url_filters.judge(pages(spark, rows)).collect()}
    told = {i: (r["host"], r["path"], r["rule"], r["verdict"]) for i, r in found.items()}
    assert told[1] == ("www.france.org", "/fr/1", "org/fr/", "allow")
    assert told[2][2:] == (None, "allow") and found[2]["trust"] > 0
    assert told[3][2:] == (None, "block") and told[5] == ("shill.com", "", None, "block")
    assert told[6] == told[7] == ("", "", None, "allow")
    assert told[8][2:] == ("example.net/en/", "allow") and told[9][2:] == told[10][2:] == ("net/", "block")
    assert told[11] == ("notnet", "", None, "allow")
    assert url_filters.judge(pages(spark, rows).limit(0)).count() == 0


# -- 8 ---------------------------------------------------------------------------------------------------


def test_quality_of_held_out_documents(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op8_quality_classifier"](spark, folder).collect()
    held = [(r["predicted"], marks[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in marks]
    assert sum(p == q for p, q in held) >= 0.95 * len(held) and {q for _, q in held} == {0, 1}
    assert all((r["score"] >= 0.7) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in rows)


def test_discriminant_equals_densities():
    rng = np.random.default_rng(5)
    model = quality.Discriminant(0.3, [rng.normal(size=3), rng.normal(size=3)], [np.linalg.cholesky(np.diag(rng.random(3) + 0.5)) for _ in "ab"])
    x = rng.normal(size=(20, 3))

    def log_density(k):
        cov = model.factors[k] @ model.factors[k].T
        gap = x - model.means[k]
        return -0.5 * (np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap) + np.log(np.linalg.det(cov)))

    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-(0.3 + log_density(1) - log_density(0)))))


def test_quality_on_awkward_tables(spark):
    for marks, table in ((labels(spark), awkward(spark)), (labels(spark, [(1, 1, 0)]), awkward(spark)), (labels(spark, []), empty(spark))):
        rows = quality.classify(table, marks, training=F.lit(True)).collect()
        assert len(rows) == table.count() and all(0 <= r["score"] <= 1 for r in rows)


# -- 9 ---------------------------------------------------------------------------------------------------


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, id string")


def test_decontamination_on_awkward_tables(spark):
    bench = items(
        spark,
        [(5, LINE, "x"), (40, "ONE!", "x"), (41, "one", "x"), (6, None, "x"), (7, "?!", "x"), (None, "end", "x"), (5, LINE, "x"), (8, "日本", "x")],
    )
    one = {r["id"]: r for r in decontaminate(awkward(spark), bench, keep=("text", "tokens")).collect()}
    assert one[1]["n_hit"] == one[1]["n_words"] == 56 and one[1]["items"] == ["5"] and list(one[1]["first_byte"]) == [0]
    assert one[3]["n_hit"] == 56 and one[3]["first_byte"] == [2] and one[3]["end_byte"] == [2 + len(LINE) * 4 - 2]
    assert one[7]["items"] == ["40", "41"] and one[10]["items"] == ["8"]
    assert one[4]["n_words"] == one[5]["n_words"] == one[6]["n_words"] == 0 and one[9]["n_hit"] == 0
    many = decontaminate(awkward(spark), bench, keep=("text", "tokens"), windows_per_pass=20).collect()
    assert sorted(map(str, many)) == sorted(map(str, decontaminate(awkward(spark), bench, keep=("text", "tokens")).collect()))
    assert decontaminate(empty(spark), bench).count() == 0
    assert {r["n_hit"] for r in decontaminate(awkward(spark), items(spark, [])).collect()} == {0}


# -- 10 --------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return Model(PIECE_MODEL)


def test_pieces_equal_the_library(model, spark, sf):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = [t for _, t in texts_of(spark, sf, 120)] + ["  a   b", "aaaaaaaaaa", "日本語とкириллица 🙂", "\n\n\tdef f(x):\n    return x", "<s></s>"]
    offsets, tokens = Encoder(model, remembered=50).encode(texts)
    for text, start, end in zip(texts, offsets, offsets[1:]):
        assert tokens[start:end].tolist() == library.encode(text)


def test_sums_of_scores_equal_all_segmentations(model, monkeypatch):
    monkeypatch.setattr(model, "kind", 1)
    solver = Encoder(model).automaton
    for text in (b" the cat", b" xyzzy", "日é🙂".encode(), b" aaaa"):
        best = {0: (0.0, [])}
        for end in range(1, len(text) + 1):
            options = [(best[end - 1][0] + solver.fallback, best[end - 1][1] + [model.byte_number[text[end - 1]]])]
            options += [(best[s][0] + model.pieces[text[s:end]][1], best[s][1] + [model.pieces[text[s:end]][0]]) for s in range(end) if text[s:end] in model.pieces]
            best[end] = max(options, key=lambda option: option[0])
        assert solver.solve(text) == best[len(text)][1]


def test_round_trip_on_awkward_tables(spark, model):
    back = decode(encode(awkward(spark), model, keep=("text", "node")), model).collect()
    assert len(back) == 14 and all(r["decoded"] == (r["text"] or "") for r in back)
    assert decode(encode(empty(spark), model), model).count() == 0
    assert decode_tokens(model.form, None) == "" and decode_tokens(model.form, [1, 2]) == ""


# -- 3, hot triggers -------------------------------------------------------------------------------------


def test_one_trigger_in_all_documents(spark, monkeypatch):
    """A phrase in ever other surroundings: its strings are dealt by their own bytes."""
    rng = random.Random(5)
    core = "the lantern of the harbour is lit at dusk by one"
    texts = []
    for i in range(400):
        before, after = ("".join(rng.choice("abcdefgh ") for _ in range(40)) for _ in range(2))
        texts.append((i, before + core + (after if i % 3 else " tail that some of them share with each other")))
    texts += [(400, None), (401, ""), (402, texts[7][1]), (402, texts[7][1]), (None, core * 3)]
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    found = []
    for most in (1 << 16, 20, 0):
        # Task functions of the package carry their module's values only if it is sent by value.
        monkeypatch.setattr(suffix_dedup, "HOT_STRINGS", most)
        monkeypatch.setattr(suffix_dedup, "_sorter", sorter_with(most))
        got = remove_repeats(rows, with_kept=True).collect()
        found.append(sorted((str(r["doc"]), r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got))
    assert found[0] == found[1] == found[2] and len(found[0]) == len(texts)
    plain = plain_removal([(i, t) for i, t in texts[:403]])
    assert {d: r for d, r, _, _ in found[0] if d != "None"} == {str(i): plain[i][1] for i, _ in texts[:403]}


def sorter_with(most, sort=suffix_dedup._sorter):
    def sorter(batches):
        from tributary.llm import suffix_dedup as module

        before, module.HOT_STRINGS = module.HOT_STRINGS, most
        try:
            yield from sort(batches)
        finally:
            module.HOT_STRINGS = before

    return sorter


# -- 11 --------------------------------------------------------------------------------------------------


def plain_top(rows, queries, k):
    out = set()
    for q, own in queries.items():
        best = sorted((-sum(w * own.get(t, 0) for t, w in v.items()), i) for i, v in rows if i != q)[:k]
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("postings", [10, 8_000_000])
def test_top_k_of_sparse_rows_equals_brute_force(spark, postings):
    rng = random.Random(11)
    vectors = [(i, {t: rng.randrange(-9, 10) for t in rng.sample(range(40), rng.randrange(0, 12))}) for i in range(120)]
    vectors += [(500 + i, {1: 3, 2: -1}) for i in range(30)] + [(600, {7: 5}), (600, {7: 5})]  # ties and a repeated row
    rows = [(i, list(v), list(v.values()), "clash") for i, v in vectors]
    rows += [(None, [1], [1], "x"), (700, None, [1], "x"), (701, [1], None, "x"), (702, [None], [1], "x"), (703, [1], [None], "x"), (704, [1], [1, 2], "x")]
    df = spark.createDataFrame(rows, "id long, terms array<int>, weights array<long>, block string").repartition(5)
    asked = df.where("id % 10 = 0")
    found = {tuple(r) for r in top_k.top_k(asked, df, k=5, postings=postings).collect()}
    assert found == plain_top(vectors, {i: v for i, v in vectors if i % 10 == 0}, 5)
    assert {len(q) for q in [[r for r in found if r[0] == 600]]} == {5}


def test_top_k_with_repeated_terms_few_rows_large_weights_and_no_rows(spark):
    ddl = "id long, terms array<int>, weights array<long>"
    df = spark.createDataFrame([(1, [3, 3, 4], [1, 2, 5]), (2, [3], [10]), (2**63 - 1, [4], [1 << 40])], ddl)
    found = {tuple(r) for r in top_k.top_k(df, df, k=5).collect()}
    large = top_k.LARGEST
    assert found == {
        (1, 1, 2**63 - 1, 5 * large), (1, 2, 2, 30), (2, 1, 1, 30), (2, 2, 2**63 - 1, 0),
        (2**63 - 1, 1, 1, 5 * large), (2**63 - 1, 2, 2, 0),
    }
    assert top_k.top_k(df, df.limit(0), k=5).count() == 0 and top_k.top_k(df.limit(0), df, k=5).count() == 0
    assert top_k.top_k(df.where("id = 1"), df.where("id = 1"), k=5).count() == 0


def test_weights_of_dense_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001, 0.0]), (2, None), (3, [1.0, None]), (4, [nan]), (5, [inf]), (6, [-inf, 1.0]), (7, [])]
    terms, weights, whole = top_k.whole_weights(F.col("v"), 256)
    df = spark.createDataFrame(rows, "id long, v array<float>").select("id", terms.alias("t"), weights.alias("w"), whole.alias("whole"))
    found = {r["id"]: (r["t"], r["w"]) for r in df.where("whole").collect()}
    assert found == {1: ([0, 1], [128, -1]), 7: ([], [])}


# -- 12 --------------------------------------------------------------------------------------------------


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("common", [20_000, 3, 0])
def test_near_words_equal_all_pairs(spark, common):
    """Words of one to many letters, many with a common start or end, also where every chunk is common."""
    rng = random.Random(12)
    words = {"a", "b", "é", "ab", "ba", "aa", "aaa", "aaaa", "aaaaa", "aaaaaa", "z" * 300, "z" * 299 + "y", "z" * 301}
    for _ in range(150):
        words.add("inter" + "".join(rng.choice("abé") for _ in range(rng.randrange(1, 5))))
        words.add("".join(rng.choice("abé") for _ in range(rng.randrange(1, 5))) + "ational")
        words.add("".join(rng.choice("ab×") for _ in range(rng.randrange(1, 7))))
    df = spark.createDataFrame([(w,) for w in sorted(words)], "word string").repartition(3)
    found = [(r["a"], r["b"]) for r in spelling.near_pairs(df, common=common).collect()]
    expected = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    assert len(found) == len(set(found)) and set(found) == expected
    assert spelling.near_pairs(df.limit(0)).count() == 0


def test_forms_and_roots(spark):
    counts = {"harbour": 40, "harbor": 20, "harbr": 10, "harbou": 5, "lamp": 9, "lump": 9, "limp": 3, "alone": 7, "bamp": 18, "camp": 18}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r["word"]: (r["form"], r["root"], r["n_near"], r["form_n"]) for r in spelling.variants(df).collect()}
    assert found["harbr"] == ("harbor", "harbour", 1, 20) and found["harbou"] == ("harbour", "harbour", 2, 40)
    assert found["harbor"] == ("harbour", "harbour", 3, 40) and found["harbour"] == (None, "harbour", 2, None)
    assert found["lump"] == (None, "lump", 2, None) and found["alone"] == (None, "alone", 0, None)
    assert found["lamp"] == ("bamp", "bamp", 4, 18) and found["limp"] == ("lamp", "bamp", 2, 9)
    assert spelling.variants(df.limit(0)).count() == 0


def test_words_of_awkward_tables(spark, monkeypatch):
    rows = awkward(spark)
    found = {r["word"]: r["n"] for r in spelling.count_words(rows, least=1, occurrences=1, every=97).collect()}
    expected = Counter()
    for r in rows.collect():
        lower = (r["text"] or "").translate({c: c + 32 for c in range(65, 91)})
        run = ""
        for letter in lower + " ":
            if "a" <= letter <= "z" or "\u00c0" <= letter <= "\u00ff":
                run += letter
                continue
            if run:
                h = crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{run}".encode())
                expected[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
            run = ""
    expected.pop("", None)
    assert found == dict(expected) and "grüße" in found
    assert spelling.count_words(empty(spark)).count() == 0


def test_runs_do_not_depend_on_slices(monkeypatch):
    text = "one, two " + "é" * 30 + " x" * 40 + "end"
    whole = [run for runs in spelling.runs_of(text) for run in runs]
    for size in (1, 2, 7, 20):
        monkeypatch.setattr(spelling, "SLICE", size)
        assert [run for runs in spelling.runs_of(text) for run in runs] == whole


# -- 13 --------------------------------------------------------------------------------------------------


def plain_middle(name, text, rate=100, suffix_first=50):
    lines = (text or "").splitlines(keepends=True) if not set(text or "") & set("\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029") else None
    if lines is None:
        parts = text.split("\n")
        lines = [p + "\n" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])
    digest = hashlib.sha256(f"7:{'' if name is None else name}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= rate:
        return len(lines), "plain", None, None, text or ""
    if h[3] % 100 < suffix_first:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def middle_texts():
    rng = random.Random(13)
    texts = ["", None, "\n", "\n\n\n", "no end", "an end\n", "a\r\nb\x0bc\u2028d\n\ne", "has <P> inside\nx", "<S>", "<M>\n", "<\nP>\n<P", "ends with <S\n<", "日本\n語\n😀é\n" * 5]
    for _ in range(150):
        texts.append("".join(rng.choice(["\n", "ab", "é", "日", "😀", "\x8a", "\n\n", " "]) for _ in range(rng.randrange(1, 60))))
    return texts + ["line\n" * 50_000 + "last", "x" * 200_000]


def test_fill_in_middle_equals_a_plain_version(spark, monkeypatch):
    rows = [(i if i % 40 else None, t, "clash", "kept") for i, t in enumerate(middle_texts())] + [(3, "\n\n\n", "clash", "kept")]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, lang string").repartition(4)
    made = fim.fill_in_middle(df, keep=("lang",))
    back = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    found = Counter((r["id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in back)
    assert found == Counter((i, *plain_middle(i, t)) for i, t, _, _ in rows)
    assert Counter(r["back"] for r in back) == Counter(t or "" for _, t, _, _ in rows) and {r["lang"] for r in back} == {"kept"}
    some = fim.fill_in_middle(df, rate=40, suffix_first=10).collect()
    assert Counter((r["id"], r["form"]) for r in some) == Counter((i, plain_middle(i, t, 40, 10)[1]) for i, t, _, _ in rows)
    assert fim.fill_in_middle(df.limit(0)).count() == 0


def test_marks_that_could_be_taken_for_others_are_refused(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for marks in (("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("<P>", "P>x", "<M>"), ("<P>", "P", "<M>"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(df, marks=marks)
    made = fim.fill_in_middle(df, marks=("[pre]", "[suf]", "[mid]")).select(fim.restored(F.col("output"), F.col("form"), ("[pre]", "[suf]", "[mid]")))
    assert made.first()[0] == "x"


def test_places_of_marked_bytes():
    rng = random.Random(14)
    data = np.array([rng.choice([0, 9, 10, 11, 0x8A, 0x0A ^ 0x80, 255, 0xC3]) for _ in range(1000)], np.uint8)
    words = np.zeros(126, np.uint64)
    words.view(np.uint8)[:1000] = data
    ends, starts = fim.Places(fim.line_ends(words)), fim.Places(fim.character_starts(words))
    places = np.flatnonzero(data == 10)
    assert ends.select(np.arange(len(places))).tolist() == places.tolist()
    at = np.arange(1001)
    assert ends.rank(at).tolist() == np.concatenate(([0], np.cumsum(data == 10))).tolist()
    assert starts.rank(at).tolist() == np.concatenate(([0], np.cumsum(data & 0xC0 != 0x80))).tolist()


# -- 2, 4 and 8 against plain fits and weights -------------------------------------------------------------


def test_licence_query_equals_sql_with_ordinary_words(spark, tmp_path):
    """Headers in the words of ordinary files: their weights need document frequencies of all terms."""
    from compare import expected, rows_of

    from tributary.llm.queries import ORACLES

    rng = random.Random(4)
    words = [f"word{k}" for k in range(60)]
    header = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
    texts = []
    for i in range(300):
        body = " ".join(rng.choice(words) for _ in range(30))
        extra = " ".join(rng.choice(words) for _ in range(rng.randrange(8)))
        texts.append((i, f"{body}\n{header} {extra}\n{body}" if i % 4 == 0 else f"{body}\nReleased under the MIT License." if i % 7 == 0 else body, "en", "s", 1))
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    found = rows_of(QUERIES["op4_license_scans"](spark, str(tmp_path)).toArrow())
    assert found == expected(None, ORACLES["op4_license_scans"], documents=df.toArrow())


def test_ordinal_fit_is_a_maximum_of_the_likelihood():
    """No step in any direction raises the penalised likelihood that the fit maximises, as differences show."""
    rng = np.random.default_rng(2)
    rows = [sorted(set(rng.integers(0, 5, 3).tolist())) for _ in range(400)]
    margin = np.array([np.array([1.5, 0.5, 0.0, -0.5, -1.5])[r].sum() for r in rows]) + rng.logistic(size=400)
    grades = np.digitize(margin, [-1.0, 1.0])
    weights, cuts = toxicity.fit_ordinal(rows, grades, np.ones(400), 5)

    def likelihood(w, c):
        bounds = np.concatenate(([-np.inf], c, [np.inf]))
        eta = np.array([w[r].sum() for r in rows])
        upper, lower = 1 / (1 + np.exp(-(bounds[grades + 1] - eta))), 1 / (1 + np.exp(-(bounds[grades] - eta)))
        return np.log(upper - lower).mean()

    best = likelihood(weights, cuts)
    for size in (0.3, 0.6):
        for k in range(5):
            for sign in (-1, 1):
                moved = weights.copy()
                moved[k] += sign * size
                assert likelihood(moved, cuts) < best + 1e-3
        assert likelihood(weights, cuts + size) < best + 1e-3 and likelihood(weights, cuts - size) < best + 1e-3


def test_discriminant_fit_equals_a_plain_one(spark):
    """Means and shrunk covariances out of sums that Spark adds up, against numpy over all rows at once."""
    rng = np.random.default_rng(8)
    width = len(quality.STATISTICS)
    x = rng.normal(size=(500, width)) @ rng.normal(size=(width, width))
    label = (rng.random(500) < 0.3).astype(int)
    rows = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, label)], "x array<double>, label int").repartition(7)
    sums = quality.class_sums(rows)
    for k in (0, 1):
        own = x[label == k]
        assert sums[k][0] == len(own) and np.allclose(sums[k][1], own.sum(axis=0)) and np.allclose(sums[k][2], own.T @ own)
    model = quality.fit(rows)
    for k in (0, 1):
        assert np.allclose(model.means[k], x[label == k].mean(axis=0))
    # Scores are the log-density differences of the two normal distributions that the fit describes.
    covariances = [factor @ factor.T for factor in model.factors]
    odds = np.full(len(x), model.prior)
    for sign, mean, covariance in zip((-1, 1), model.means, covariances):
        gap = x - mean
        odds += sign * -0.5 * (np.einsum("ij,jk,ik->i", gap, np.linalg.inv(covariance), gap) + np.linalg.slogdet(covariance)[1])
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-np.clip(odds, -40, 40))))
