"""Prefix trie, collocations and language: against brute force, odd rows, hot groups."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.llm import language, phrases, queries, tries

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, tid string, n long, path string"


def trie_by_hand(rows):
    """Every prefix as a key; sums by walking the prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tid = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), tid, role, text))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    members = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append((c, len(whole) == d))
    children, leaves, saved, out = defaultdict(list), {}, {}, []
    for p in members:
        if p:
            children[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        ends = ",".join(str(c) for c in sorted(c for c, end in members[p] if end))
        above = min(members[p[:-1]])[0] if p else None
        out.append((min(members[p])[0], len(p), above, len(members[p]), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def trie_rows(frame, **limits):
    return sorted((tuple(r) for r in tries.prefix_trie(frame, **limits).collect()), key=lambda r: r[:2])


def plain(frame):
    return [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]


def talk(conv, texts):
    return [(conv, i, "user", t, "t", 1, "p") for i, t in enumerate(texts)]


def test_trie_of_the_table(spark):
    frame = spark.read.parquet(f"{SMALL}/conversations.parquet")
    assert sorted((tuple(r) for r in queries.op11_prefix_trie(spark, SMALL).collect()), key=lambda r: r[:2]) == trie_by_hand(plain(frame))


@pytest.mark.parametrize("limits", [{}, {"container": 2, "longest": 4}])
def test_trie_of_odd_turns(spark, limits):
    rows = talk(0, ["a", "b", "c", "d", "e", "f", "g", "h", "i"] * 12)  # one very long conversation
    for c in range(1, 30):
        rows += talk(c, ["same"] * 9 + (["x", "y"] if c % 3 else ["z"]))  # a group of copies
    rows += talk(-7, ["a"]) + talk(6, ["short"])  # a stem that isn't there; fewer turns than the stem lends
    rows += [(None, 1, "user", "lost", None, None, None), (40, None, None, None, None, None, None), (40, 2, "user", "é" * 50_000, None, None, None)]
    rows += [(40, 2, "user", "tie", None, None, None), (40, 2, "user", "tie", None, None, None)]  # ties, a repeated row
    frame = spark.createDataFrame(rows, TURNS)
    assert trie_rows(frame, **limits) == trie_by_hand(plain(frame))


def test_trie_bursts_through_long_common_starts(spark):
    rows = [r for c in range(0, 200, 5) for r in talk(c, [f"s{i}" for i in range(40)] + [f"own {c % 7}", f"{c}"])]
    frame = spark.createDataFrame(rows, TURNS)
    assert trie_rows(frame, container=5, longest=100) == trie_by_hand(plain(frame))


def test_pieces_of_many_members_hash_as_one_text(spark, monkeypatch):
    monkeypatch.setattr(tries, "PIECE_IDS", 3)
    frame = spark.createDataFrame([r for c in range(0, 60) for r in talk(c, ["one"] * 9)], TURNS)
    assert trie_rows(frame) == trie_by_hand(plain(frame))


def test_trie_without_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    assert trie_rows(none) == []
    assert trie_rows(spark.createDataFrame([(None, 1, "user", "x", None, None, None)], TURNS)) == []


def phrases_by_hand(rows, least, most=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    often = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    dropped = {
        (lang, p[i : i + m]) for (lang, p), a in often.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= 80 * often[lang, p[i : i + m]]
    }
    lists = defaultdict(list)
    for (lang, p), a in often.items():
        if (lang, p) not in dropped:
            score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            lists[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, v in lists.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:most])}


def phrase_rows(frame, *limits):
    rows = [tuple(r) for r in phrases.collocations(frame, *limits).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_phrases_of_the_table(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {tuple(r) for r in queries.op12_phrase_collocations(spark, SMALL).collect()}
    assert found == phrases_by_hand([(r.lang, r.text) for r in frame.collect()], 30)


ODD_TEXTS = [
    ("en", "The the the the the, the the. A b c d e f g; a b c d e f g! x a b c d e f g"),
    ("EN", "the the the the"),
    (None, "no language here no language here"),
    ("und", "No LANGUAGE here"),
    (None, None),
    ("en", ""),
    ("en", " \t\n.,;"),
    ("fr", "é  è\té è é è É È"),
    ("en", "long line of words " * 9000),
    ("en", "r s t r s t r s t r s t r s t"),  # a ring of edges
    ("en", "p q r s u v w\x00y z p q r s u v w\x00y z"),
]


@pytest.mark.parametrize("least, most", [(2, 2000), (3, 4), (9000, 10)])
def test_phrases_of_odd_texts(spark, least, most):
    frame = spark.createDataFrame([(t, g, "s", 1, "p", 2) for g, t in ODD_TEXTS] * 2, "text string, lang string, phrase string, n long, high string, n_words int")
    assert phrase_rows(frame, least, most) == phrases_by_hand(ODD_TEXTS * 2, least, most)


def test_phrases_whose_numbers_collide(spark, monkeypatch):
    """With numbers of three bits nearly all words share theirs: counts by text must set them right."""
    real = phrases.Grams.__init__

    def coarse(self, texts, langs):
        real(self, texts, langs)
        self.numbers = np.where(self.numbers > 0, self.numbers % 8 + 1, 0).astype(np.uint32)

    monkeypatch.setattr(phrases.Grams, "__init__", coarse)
    texts = [("en", "ab cd ab cd ab ef gh ab cd. abc de fgh abc de fgh ij kl mn op qr st uv wx yz")] * 3 + [("fr", "ab cd xy cd ab")] * 3
    frame = spark.createDataFrame([(t, g) for g, t in texts], "text string, lang string")
    # The patch holds in this process only: the tasks' functions are run here.
    import pyarrow as pa

    batch = [pa.RecordBatch.from_arrays([pa.array([t for _, t in texts]), pa.array([g for g, _ in texts])], names=["text", "lang"])]
    everything = np.full(1 << 15, 255, dtype=np.uint8)
    by_text = Counter()
    for b in phrases._texts(everything, counted=True)(batch):
        for r in b.to_pylist():
            by_text[r["n_words"], r["lang"], r["phrase"]] += r["n"]
    by_hand = Counter()
    for lang, text in texts:
        for piece in text.split("."):
            w = piece.split()
            by_hand.update((k, lang, " ".join(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
            by_hand[0, lang, ""] += len(w)
    assert by_text == by_hand
    once = [r for b in phrases._texts(everything, counted=False)(batch * 2) for r in b.to_pylist() if r["n_words"]]
    assert len({(r["lang"], r["phrase"]) for r in once}) == len(once) == len(by_hand) - 2

    original = DataFrame.mapInArrow

    def here(self, f, schema, *rest):
        rows = [pa.RecordBatch.from_pandas(self.toPandas(), preserve_index=False)]
        out = [r for b in f(iter(rows)) for r in b.to_pylist()] if len(rows[0]) else []
        return spark.createDataFrame([tuple(r.values()) for r in out], schema)

    monkeypatch.setattr(type(frame), "mapInArrow", here)
    found = phrase_rows(frame, 3)
    monkeypatch.setattr(type(frame), "mapInArrow", original)
    assert found == phrases_by_hand(texts, 3)


def test_paths_are_compacted(spark):
    texts = [("en", " ".join(f"w{i}" for i in range(40)))] * 3 + [("en", "r s t " * 4)]
    frame = spark.createDataFrame([(t, g) for g, t in texts], "text string, lang string")
    paths = phrases.compacted_paths(phrases.frequent_grams(frame, 3)).collect()
    first = Counter((r.path_high, r.path_low) for r in paths)
    assert first.most_common(1)[0][1] == 37  # 37 edges of four words in one path
    long = [r.place for r in paths if (r.path_high, r.path_low) == first.most_common(1)[0][0]]
    assert sorted(long) == list(range(37))


def test_phrases_of_no_texts(spark):
    assert phrase_rows(spark.createDataFrame([], "text string, lang string")) == set()


def test_language_equals_plain_naive_bayes(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("the sun", "en"), ("die sonne", "de"), ("le chien et le chat", "fr")] * 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, buckets=1 << 20)
    counts, n = defaultdict(Counter), Counter()

    def grams(text):
        padded = f" {text.lower()} "
        return [padded[i : i + k] for k in (1, 2, 3) for i in range(len(padded) - k + 1)]

    for i, t, lang in rows:
        if zlib.crc32(str(i).encode()) % 5:
            counts[lang].update(grams(t))
            n[lang] += 1
    texts = ["the house", "die", "Le"]
    found = language.log_likelihoods(texts, model)
    for i, t in enumerate(texts):
        for j, lang in enumerate(model.languages):
            total = sum(counts[lang].values()) + language.SMOOTHING * (1 << 20)
            want = math.log(n[lang] / sum(n.values())) + sum(math.log((counts[lang][g] + language.SMOOTHING) / total) for g in grams(t))
            assert abs(found[i, j] - want) < 1e-6


def test_language_does_not_depend_on_parts(monkeypatch):
    texts = ["ab" * 50, None, "", "äöü é " * 30, "x"]
    model = language.Model(["a", "b"], np.log([0.5, 0.5]), np.log(np.random.default_rng(1).random((1 << 10, 2))))
    whole = language.log_likelihoods(texts, model)
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(language, "PART_CHARS", size)
        monkeypatch.setattr(language, "PART_CELLS", 8)
        assert np.allclose(language.log_likelihoods(texts, model), whole)


def test_language_of_held_out_documents(spark):
    rows = queries.op13_language(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.98 * len(tested)


def test_language_of_odd_rows(spark, odd, none):
    rows = language.classify(odd).collect()
    assert len(rows) == odd.count() and {r.lang_pred for r in rows} <= {"en", "und"}
    by = {r.doc_id: r for r in rows}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (3, 4, 7)) and by[1].lang_pred == "en" and by[5].score == 1.0
    assert language.classify(none).collect() == []
    unlearned = language.classify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)} and len(unlearned) == odd.count()
