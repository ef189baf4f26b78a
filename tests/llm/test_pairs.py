"""Near duplicates, components, tool calls and the pipeline against brute force."""

import json
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from revrank.llm import common, minhash, queries, toolcalls, vectors

SMALL = "/root/testdata/sf0.001"


def plain_components(ids, linked):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def shingle_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_near(texts, percent=75):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    ids = sorted(sets)
    linked = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    linked.append((a, b))
    return sets, plain_components(ids, linked)


def test_components(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 2000 + i) for i in range(100)]
    got = {r.id: r.component for r in common.components(spark.createDataFrame([*edges, (None, 1), (7, 7)], "a long, b long")).collect()}
    want = plain_components({x for e in edges for x in e}, edges)
    assert got == {i: c for i, c in want.items() if i in got}
    assert all(i in got for e in edges if e[0] != e[1] for i in e)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    sets, want = plain_near(texts)
    rows = queries.op7_minhash_near_dedup(spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {i: (len(sets[i]), want[i], want[i] == i) for i in texts}


def test_group_whose_members_are_only_partly_alike(spark):
    """One text with more and more words changed: many share keys, only some are alike."""
    draw = random.Random(9)
    base = [f"word{i}" for i in range(150)]
    texts = {}
    for i in range(140):
        words = list(base)
        for at in draw.sample(range(150), draw.choice([1, 2, 4, 6, 8, 12])):
            words[at] = f"other{i}_{at}"
        texts[i] = " ".join(words)
    _, want = plain_near(texts)
    assert len(set(want.values())) > 5
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == want


def test_signatures_within_reach_share_a_key(spark):
    draw = np.random.default_rng(4)
    a = draw.integers(0, 1 << minhash.BITS, minhash.PLACES)
    rows = []
    for i in range(40):
        b = a.copy()
        b[draw.choice(minhash.PLACES, minhash.REACH, replace=False)] ^= 1
        rows.append((i, a.tolist(), b.tolist()))
    df = spark.createDataFrame(rows, "i long, a array<int>, b array<int>")
    assert df.selectExpr("*").select(minhash.keys(df.a).alias("x"), minhash.keys(df.b).alias("y")).selectExpr("arrays_overlap(x, y) o").filter("NOT o").count() == 0


def test_similar_pair_whose_signatures_are_far_apart(spark):
    """31 of 41 shingles in common and a key too, but 20 of 40 places differ."""
    words = [f"w2817_{i}" for i in range(40)]
    texts = {1: " ".join(words), 2: " ".join([*words[:20], "other", *words[21:]])}
    a, b = (np.array(s["places"]) for s in minhash.sketches([*texts.values()]))
    apart = (a != b).reshape(minhash.CHUNKS, minhash.CHUNK).sum(axis=1)
    assert apart.sum() > minhash.REACH and apart.min() <= minhash.ERRORS
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == {1: 1, 2: 1}


def test_near_duplicates_of_odd_rows(odd, none):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[10].component_id == by[2].component_id == 1 and by[13].component_id == 12
    assert by[3].n_shingles == by[4].n_shingles == by[7].n_shingles == 0 and by[7].kept and by[4].kept
    assert by[None].component_id is None and not by[None].kept
    assert by[9].n_shingles == 1
    assert minhash.near_duplicates(none).count() == 0


def test_texts_of_one_id_are_linked(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (2, "x y z"), (3, "x y z"), (4, "q")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def plain_vectors(rows, least=0.98):
    usable = [k for k, (_, v, label) in enumerate(rows) if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    linked = []
    for n, a in enumerate(usable):
        for b in usable[n + 1 :]:
            x, y = np.array(rows[a][1], dtype=float), np.array(rows[b][1], dtype=float)
            if rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                linked.append((a, b))
    links = [sum(k in e for e in linked) for k in range(len(rows))]
    label = plain_components(range(len(rows)), linked)
    ids = {}
    for k, (i, _, _) in enumerate(rows):
        ids.setdefault(label[k], []).append(i)
    return sorted((i, links[k], min(ids[label[k]])) for k, (i, _, _) in enumerate(rows))


def test_near_vectors(spark):
    draw = np.random.default_rng(6)
    rows = []
    for label in range(3):
        for center in draw.normal(size=(30, 16)):
            for _ in range(draw.integers(1, 6)):
                rows.append((len(rows), [float(np.float32(x)) for x in center + draw.normal(size=16) * 0.05], label))
    for vector in (None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0] * 8):
        rows.append((len(rows), vector, 1))
    rows += [(len(rows), [1.0] * 16, None), (len(rows) + 1, [1.0] * 16, None)]
    rows += [(len(rows) + i, [2.0] * 16, 1) for i in range(20)] + [(len(rows) + 20, [4.0] * 16, 1), (len(rows) + 20, [4.0] * 16, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, digest string")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(df).collect())
    assert got == plain_vectors(rows)
    assert vectors.near_vectors(df.limit(0)).count() == 0
    assert len(queries.op8_vector_near_dedup(spark, SMALL).collect()) == spark.read.parquet(f"{SMALL}/embeddings.parquet").count()


def test_dense_group_is_found_with_small_windows(spark):
    draw = np.random.default_rng(8)
    center = draw.normal(size=32)
    rows = [(i, (center + draw.normal(size=32) * 0.03).tolist(), 1) for i in range(300)]
    rows += [(300 + i, draw.normal(size=32).tolist(), 1) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in vectors.near_vectors(df, window=64).collect()}
    want = plain_vectors(rows)
    assert all(got[i].component_id == c for i, _, c in want)
    assert sum(got[i].n_links for i, _, _ in want) > 0.9 * sum(n for _, n, _ in want)


@pytest.mark.parametrize("window", [16, 512])
def test_every_row_of_several_passes_equals_brute_force(spark, window):
    """Pairs well above the threshold or well below it, in groups smaller and larger than the window."""
    draw = np.random.default_rng(21)
    rows = []
    for size in [1] * 300 + [2] * 150 + [5] * 40 + [90, 300]:
        center = draw.normal(size=24)
        rows += [(center + draw.normal(size=24) * 0.04).tolist() for _ in range(size)]
    rows = [(i, rows[j], i % 2) for i, j in enumerate(draw.permutation(len(rows)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(df, window=window).collect())
    assert got == plain_vectors(rows)


def test_links_of_groups_denser_than_any_window(spark):
    """A group of 5,000 alike, and 5,000 vectors with a common direction, some of them alike."""
    draw = np.random.default_rng(12)
    dense = draw.normal(size=32) + draw.normal(size=(5000, 32)) * 0.05
    common_mean = 3.0 * np.ones(32) / 32**0.5 + draw.normal(size=(2500, 32)) * 1.45 / 32**0.5
    common_mean = np.concatenate([common_mean, common_mean + draw.normal(size=(2500, 32)) * 0.05])
    rows, want = [], {}
    for label, x in enumerate((dense, common_mean)):
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        want |= {len(rows) + i: int(n) - 1 for i, n in enumerate((unit @ unit.T >= 0.98).sum(axis=1))}
        rows += [(len(rows) + i, v.tolist(), label) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(8)
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    for ids in (range(5000), range(5000, 10000)):
        found, all_links = sum(got[i].n_links for i in ids), sum(want[i] for i in ids)
        assert all_links > 4000 and all_links * (1 - vectors.MISSED) <= found <= all_links
    assert {got[i].component_id for i in range(5000)} == {0}


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            ("c", 1, "a", "add", '{"y": 2, "x": 1}'),
            ("c", 2, "b", "add", '{"x": {"$call": "a"}, "y": 1}'),
            ("c", 3, "d", "add", '{"x": 1, "y": 2, "z": {"$call": "b"}}'),
            ("c", 4, "e", "mul", "{}"),
            ("c", 5, "f", "add", "no json"),
            ("c", 6, "g", "add", '{"x": {"$call": "h"}, "y": 1}'),
            ("c", 7, "h", "add", '{"x": {"$call": "g"}, "y": 1}'),
            ("k", 1, "a", "add", None),
            (None, 1, "a", "add", "{}"),
        ],
        "conversation string, turn long, call_id string, name string, arguments string",
    )
    results = spark.createDataFrame(
        [("c", 9, "a", "3"), ("c", 8, "a", "2"), ("c", 1, "b", "?"), ("z", 1, "a", "lost"), (None, 1, "a", "no one's")],
        "conversation string, turn long, call_id string, content string",
    )
    schemas = {"add": (toolcalls.Parameter("x", "number"), toolcalls.Parameter("y", "integer"))}
    found = toolcalls.linked_calls(calls, results, schemas).collect()
    rows = {(r.conversation, r.call_id, r.turn): r for r in found if r.status != "extra"}
    assert [(r.conversation, r.call_id, r.result_turn, json.loads(r.json)["result"]) for r in found if r.status == "extra"] == [("c", "a", 9, "3")]
    c = {k[1]: r for k, r in rows.items() if k[0] == "c"}
    assert (c["a"].status, c["a"].result_turn, c["a"].n_results, c["a"].level, c["a"].problems) == ("linked", 8, 2, 0, "")
    assert json.loads(c["a"].json)["arguments"] == {"x": 1, "y": 2} and c["a"].json.startswith('{"arguments":{"x":1,"y":2},"id":"a"')
    assert (c["b"].status, c["b"].level, c["b"].problems) == ("early", 1, "not number: x")
    assert (c["d"].level, c["d"].problems) == (2, "unknown: z")
    assert (c["e"].status, c["e"].problems) == ("unanswered", "unknown tool: mul")
    assert c["f"].problems == "arguments are no object" and c["g"].level is None and c["h"].level is None
    assert c["a"].position < c["b"].position < c["d"].position < c["g"].position
    assert rows["k", "a", 1].problems == "arguments are no object"
    assert sorted(r.status for k, r in rows.items() if k[0] in (None, "z")) == ["orphan", "orphan", "unanswered"]
    assert toolcalls.linked_calls(calls.limit(0), results.limit(0), schemas).count() == 0


def test_turns_as_calls(spark):
    """Every turn comes out: as a call, as the result of one, or as a row of its own."""
    turns = spark.createDataFrame(
        [
            (1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 2, "assistant", "a2"), (1, 2, "assistant", "a"), (1, 3, "user", None),
            (2, 0, "assistant", "x"), (None, 0, "user", "u"), (1, 1, "user", "q"), (1, None, "user", "w"), (None, None, "assistant", "n"), (3, 0, None, "r"), (3, 1, "tool", None),
        ],
        "conv_id long, turn long, role string, text string",
    )
    extra_columns = turns.selectExpr("*", "1 AS content", "2 AS level", "3 AS n_results", "4 AS result_turn", "5 AS status", "6 AS name")
    for table in (turns, extra_columns):
        calls, results, context = toolcalls.from_turns(table)
        rows = toolcalls.linked_calls(calls, results, toolcalls.REPLY, context).collect()
        told = sorted(((r.conversation, r.call_id, r.turn, r.result_turn, r.status, r.problems, r.level) for r in rows), key=str)
        assert told == sorted([
            (1, "call_1", 1, 2, "linked", "", 0), (1, "call_1", 1, 2, "linked", "", 0), (1, "call_1", None, 2, "extra", None, None), (1, "call_1", None, 2, "extra", None, None),
            (1, "call_3", 3, None, "unanswered", "missing: text", 1), (1, None, None, None, "unanswered", "missing: turn", None), (None, "call_0", 0, None, "unanswered", "", None),
            (2, "call_-1", None, 0, "orphan", None, None), (None, None, None, None, "orphan", None, None),
            (1, None, 0, None, "context", None, None), (3, None, 0, None, "context", None, None), (3, None, 1, None, "context", None, None),
        ], key=str)
        texts = sorted(json.loads(r.json).get("result") or "" for r in rows if r.status in ("extra", "context", "orphan"))
        assert texts == ["", "a", "a2", "n", "r", "s", "x"]


def test_turns_reconcile_with_the_table(spark):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = queries.op6_tool_calls(spark, SMALL).collect()
    n = {r.role: r["count"] for r in turns.groupBy("role").count().collect()}
    by = Counter(r.status for r in rows)
    assert by["linked"] + by["early"] + by["unanswered"] == n["user"] and by["context"] == n.get("system", 0)
    answered = {(r.conversation, r.call_id) for r in rows if r.status in ("linked", "early")}
    assert len(answered) + by["orphan"] + by["extra"] == n["assistant"]


def test_calls_with_columns_of_the_results_own_names(spark):
    calls = spark.createDataFrame([("c", 1, "a", "add", "{}", 7, 8, 9, 10)], "conversation string, turn long, call_id string, name string, arguments string, content long, level long, n_results long, result_turn long")
    results = spark.createDataFrame([("c", 2, "a", "3", 5, "x")], "conversation string, turn long, call_id string, content string, level long, name string")
    row = toolcalls.linked_calls(calls, results, {"add": ()}).collect()[0]
    assert (row.status, row.result_turn, row.level, row.n_results) == ("linked", 2, 0, 1)


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_pipeline_stages_one_by_one(spark, odd, none, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd.select(*COLUMNS), none.select(*COLUMNS), odd):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
    docs = odd.select(*COLUMNS)
    deduped = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(deduped, key=str) == sorted([0, 1, 3, 4, 5, 6, 7, 8, 9, 11, 12, 14, None], key=str)
    hidden = {r.doc_id: r for r in corpus_pipeline.hide_secrets(spark, docs, "").collect()}
    assert hidden[14].n_chars == len(hidden[14].text) and hidden[3].n_chars is None


def test_pipeline_against_its_parts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    toxic = {r.doc_id for r in queries.op10_toxicity(spark, SMALL).collect() if r.toxic}
    clean = corpus_pipeline.drop_toxic(spark, docs, SMALL)
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - toxic
    good = corpus_pipeline.drop_low_quality(spark, clean, SMALL)
    texts = {r.doc_id: r.text for r in good.collect()}
    _, want = plain_near(texts)
    once = corpus_pipeline.drop_near_duplicates(spark, good, SMALL)
    assert {r.doc_id for r in once.collect()} == {i for i, c in want.items() if i == c}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == {i for i, c in want.items() if i == c}


@pytest.mark.parametrize("name", ["pipeline", *queries.QUERIES])
def test_registered(name):
    import __spark_entry__

    assert name in __spark_entry__.queries()
