"""Encoding, licences, secrets, packing and fingerprints against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from revrank.llm import licenses, packing, pieces, queries, secrets, spotsigs
from revrank.llm.words import LETTERS, NOT_SPACE, Words

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def all_texts(odd):
    return [(r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect()]


def test_words_are_those_of_the_patterns():
    texts = ["", "A b", "  x\x0by ", "é-日本_ü9", "a" * 1000 + " b", "*** b"]
    for letters, pattern in ((NOT_SPACE, r"[^\x20\x09-\x0D]+"), (LETTERS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = Words([t.encode() for t in texts], letters)
        found = [bytes(words.data[a:b]).decode() for a, b in zip(words.start, words.end)]
        want = [re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in texts]
        assert found == [w for own in want for w in own]
        assert np.diff(words.first).tolist() == [len(w) for w in want]
        hashes = words.hashes()
        assert len(set(hashes.tolist())) == len(set(found))
        assert (hashes[np.array(found) == "b"] == hashes[found.index("b")]).all()


def test_pieces_match_the_library():
    own, library = pieces.PieceCodec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    random.seed(3)
    signs = [*"ab  \n\t▁éñ日𠮷!.<>-=01AB'\"\x00²", "the", "  ", "    ", " a", "ing", "word."]
    for _ in range(3000):
        text = "".join(random.choices(signs, k=random.randint(0, 24)))
        ids = [1, *library.encode(text), 2]
        assert own.encode(text).tolist() == ids
        assert own.decode(np.array(ids)) == library.decode(ids)
    for _ in range(3000):
        ids = random.choices([0, 1, 2, *range(3, 259), *range(259, 32000, 97)], k=random.randint(0, 9))
        assert own.decode(np.array(ids, dtype=np.int64)) == library.decode(ids)


def test_remembering_is_bounded_and_keeps_answers(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    memory = pieces.Remembered(lambda x: x * 2)
    assert [memory[i] for i in (1, 2, 3, 4, 1, 5, 6, 7, 2)] == [2, 4, 6, 8, 2, 10, 12, 14, 4]
    assert len(memory) <= 3


def test_round_trip(odd, none, docs, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def want(text):
        ids = library.encode(text, add_bos=True, add_eos=True)
        return len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()

    got = Counter(tuple(r) for r in pieces.round_trip(odd, PIECES).collect())
    assert got == Counter((i, *want(t)) for i, t in all_texts(odd))
    assert pieces.round_trip(none, PIECES).count() == 0
    for r in pieces.round_trip(docs, PIECES).collect():
        assert tuple(r)[1:] == want(texts[r.doc_id])
    ids = odd.select(pieces.encode_column(odd.text, PIECES).alias("ids"), "text")
    back = ids.select(pieces.decode_column(ids.ids, PIECES).alias("back"), "text").collect()
    assert all(r.back == (r.text or "").replace("▁", " ") for r in back)


def plain_licences(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    hits = [(i, k) for k, p in phrases.items() for i in range(len(words)) if words[i : i + len(p)] == p]
    at = [i for i, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({k for _, k in hits}))


def test_licences(odd, none, spark, docs, texts):
    rows = licenses.report(licenses.scan(odd)).collect()
    assert Counter(tuple(r)[:6] for r in rows) == Counter((i, *plain_licences(t)) for i, t in all_texts(odd))
    assert {r.labels for r in rows if r.doc_id == 6} == {"cc-by,cc-by-nc,gpl,reserved"}
    assert all(0 <= r.score <= 1 for r in rows)
    assert licenses.report(licenses.scan(none)).count() == 0
    for r in queries.op3_license_scan(spark, SMALL).collect():
        assert tuple(r)[1:6] == plain_licences(texts[r.doc_id])


def test_a_notice_is_found_with_some_words_changed_but_not_without_its_phrase():
    index = licenses.Index(licenses.NOTICES)

    def labels(text):
        words = Words([text.encode()], LETTERS)
        return {index.templates[k].label for k, _, _ in index.find(index.numbers(words.hashes()))}

    assert labels("some words Licensed under the Apache License, edition 2.0 more") == {"apache"}
    assert labels("licensed under the apache agreement version 2 0") == set()
    assert labels("apache license") == set()


def notices_by_hand(text, templates, rarity):
    """Every template laid at every word of a text."""
    words = re.findall("[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    out = []
    for k, t in enumerate(templates):
        row = t.text.split()
        weight = [rarity.get(w, 1.0) for w in row]
        needed, lead = set(), None
        for phrase in t.phrases:
            size = len(phrase.split())
            at = next(j for j in range(len(row)) if row[j : j + size] == phrase.split())
            needed |= set(range(at, at + size))
            lead = at if lead is None else lead
        for start in range(-len(row), len(words) + 1):
            same = [0 <= start + j < len(words) and words[start + j] == w for j, w in enumerate(row)]
            support = sum(w for s, w in zip(same, weight) if s) / sum(weight)
            if all(same[j] for j in needed) and support >= licenses.SUPPORT:
                out.append((start + lead, k, round(support, 9)))
    return sorted(out)


def test_notices_against_every_place():
    """Finds of the index equal laying every notice everywhere, with 22 notices and with 300."""
    draw = random.Random(5)
    templates = licenses.BASE + licenses.NOTICES
    texts = [t.text for t in templates]
    for t in templates:  # cut, changed and joined notices
        words = t.text.split()
        texts += [" ".join(words[1:]), " ".join(words[:-1]), " ".join(w if draw.random() < 0.8 else "other" for w in words), "x " + t.text.upper() + " " + " ".join(words[: len(words) // 2])]
    texts += ["", "cc by", "all rights reserved all rights reserved", "license " * 50]
    many = tuple(licenses.Template(f"l{i}", text, (" ".join(text.split()[j : j + 2]),)) for i in range(277) for text in [draw.choice(texts[3:22])] for j in [draw.randrange(max(1, len(text.split()) - 2))])
    for own in (templates, templates + many):
        rarity = {w: 1 + draw.random() * 5 for t in own for w in t.text.split()}
        index = licenses.Index(own, rarity)
        words = Words([t.encode() for t in texts], LETTERS)
        doc, template, word, support = index.find(index.numbers(words.hashes()), words.doc)
        got = [[] for _ in texts]
        for d, k, w, s in zip(doc.tolist(), template.tolist(), word.tolist(), support.tolist()):
            got[d].append((w - int(words.first[d]), k, round(s, 9)))
        assert [sorted(g) for g in got] == [notices_by_hand(t, own, rarity) for t in texts]


def plain_secrets(text):
    assign = r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_secrets(odd, none, spark, docs, texts):
    rows = secrets.report(secrets.scan(odd)).collect()
    want = Counter((i, hashlib.sha256(plain_secrets(t).encode()).hexdigest()) for i, t in all_texts(odd))
    assert Counter((r.doc_id, r.base_sha256) for r in rows) == want
    by = {r.doc_id: r for r in rows}
    # Two sources have the password, one has the key, the hex string and the token.
    assert (by[0].n_live, by[0].n_copied) == (2, 1)
    assert (by[11].n_live, by[11].n_copied) == (0, 1)
    assert (by[14].n_live, by[14].n_copied) == (1, 0)
    assert secrets.report(secrets.scan(none)).count() == 0
    for r in queries.op4_secret_scan(spark, SMALL).collect():
        assert r.base_sha256 == hashlib.sha256(plain_secrets(texts[r.doc_id]).encode()).hexdigest()
        assert set(filter(None, plain_secrets(texts[r.doc_id]).split(","))) <= set(r.spans.split(","))


def test_opaque_strings_and_unicode_letters():
    assert [c[0] for c in secrets.candidates("see Zm9vYmFyQmF6cXV4MTIzNDU2Nzg5 there")] == ["opaque"]
    assert not [*secrets.candidates("toKen = abcdefgh and zzzzzzzzzzzzzzzzzzzzzzzzzzzzzz1B")]


def test_redaction_hides_live_values_only(odd, none):
    out = {r.doc_id: r.text for r in secrets.redact(odd).collect()}
    assert out[14] == secrets.HIDDEN
    assert out[11] == "password = 'abcdef123'"
    assert out[0] == f"password = 'abcdef123' and {secrets.HIDDEN} then {secrets.HIDDEN}"
    assert secrets.redact(odd).count() == odd.count() and secrets.redact(odd).columns == odd.columns
    assert out[3] is None and secrets.redact(none).count() == 0


def test_redaction_keeps_columns_of_any_name(odd):
    named = odd.selectExpr("*", "1 AS _live", "2 AS _secret_key", "3 AS key", "4 AS live", "5 AS doc", "6 AS row", "7 AS repository", "8 AS owner")
    for r in secrets.redact(named).collect():
        assert tuple(r)[-8:] == (1, 2, 3, 4, 5, 6, 7, 8)
    assert Counter(r.text for r in secrets.redact(named).collect()) == Counter(r.text for r in secrets.redact(odd).collect())


def check_packing(rows, texts, capacity=4096):
    library = tokenizers.Tokenizer.from_file(WORDS)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    want = Counter()
    for i, text in texts:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        for number, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want[i, number, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    return len(sequences)


def test_packing(odd, none, spark, texts):
    check_packing(packing.pack(odd, WORDS).collect(), all_texts(odd))
    check_packing(packing.pack(odd, WORDS, capacity=64).collect(), all_texts(odd), 64)
    assert packing.pack(none, WORDS).count() == 0
    rows = queries.op9_packing(spark, SMALL).collect()
    used = check_packing(rows, texts.items())
    assert used <= -(-sum(r.length for r in rows) // 4096) + 1


def test_word_ids_match_the_library():
    own, library = packing.WordIds(WORDS), tokenizers.Tokenizer.from_file(WORDS)
    odd = ["", "Plain Text, 1234 {ß} ÉÀ ñ##\n\tend", "<|endoftext|>a <|startoftext|> b", "it's 'LL don't", "é ́x ñandú ÀB1 x<y a<|b|>", "İ ſ K \x1c x\x85y", "日本  語", "a\r\nb\x0bc\td", "ΑΣ. Σ", "x²y ªº ×÷ 12½"]
    assert [own.encode(t).tolist() for t in odd] == [[*library.encode(t, add_special_tokens=False).ids, 1] for t in odd]


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    random_ = np.random.default_rng(seed)
    histogram = np.zeros(101, dtype=np.int64)
    for n in random_.integers(1, 101, 30):
        histogram[n] += random_.integers(1, 400)
    own = packing.plan(histogram)
    length = np.repeat(np.arange(101), histogram)
    rank = np.concatenate([np.arange(c) for c in histogram])
    sequence, offset = own.place(length, rank)
    filled = np.zeros((own.sequences, 100), dtype=int)
    for s, o, n in zip(sequence, offset, length):
        filled[s, o : o + n] += 1
    assert filled.max() == 1 and (np.diff(filled, axis=1) <= 0).all()
    assert own.sequences <= max(sum(packing.best_fit(histogram).values()), 1)


def covered(groups, capacity):
    out = np.zeros(capacity + 1, dtype=np.int64)
    for group, times in groups:
        assert sum(group) <= capacity and times > 0
        for n in group:
            out[n] += times
    return out


@pytest.mark.parametrize("times, seed", [(1, 0), (1, 1), (1000, 0)])
def test_program_is_solved(times, seed):
    """All pieces are covered, near the bound no packing can go below, and rounding keeps nearly all of it."""
    random_ = np.random.default_rng(seed)
    histogram = np.bincount(np.minimum(4096, random_.lognormal(6.4, 1.0, 4000).astype(int) + 1), minlength=4097) * times
    found = packing.solution(histogram)
    assert (covered(found, 4096) == histogram).all()
    n, bound = sum(k for _, k in found), -(-int((histogram * np.arange(4097)).sum()) // 4096)
    assert n <= 1.01 * bound + 1
    for undone in packing.UNDONE:
        whole = packing.rounded(found, 4096, undone)
        assert (covered(whole.items(), 4096) == histogram).all()
        kept = whole & Counter(dict(found))
        assert sum(kept.values()) >= 0.95 * n - packing.FEW
    assert packing.plan(histogram).sequences <= n


def test_knapsack_against_all_subsets():
    random_ = np.random.default_rng(7)
    for _ in range(30):
        lengths = np.unique(random_.integers(1, 40, 5))
        copies, prices = random_.integers(1, 5, len(lengths)), random_.random(len(lengths)) * lengths
        room = int(random_.integers(1, 90))
        best = max(
            sum(t * p for t, p in zip(times, prices)) for times in itertools.product(*(range(min(c, 3) + 1) for c in copies)) if sum(t * n for t, n in zip(times, lengths)) <= room
        )
        group = packing.knapsack(prices, lengths, copies, room)
        assert sum(group) <= room and all(group.count(n) <= min(c, 3) for n, c in zip(lengths, copies))
        assert abs(sum(prices[list(lengths).index(n)] for n in group) - best) < 1e-9


def plain_edit(texts):
    ids = sorted(texts, reverse=True)
    for k, i in enumerate(ids):
        text, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        yield i, text[: len(text) - half] + after[:half], after


def test_spot_signatures(spark, texts):
    rows = {r.doc_id: r for r in queries.op1_spot_signatures(spark, SMALL).collect()}
    assert len(rows) == len(texts)
    for i, edited, after in plain_edit(texts):
        assert rows[i].n_chars == len(texts[i])
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (rows[i].near_next == 1.0) >= (texts[i] == after)
        assert 0 <= rows[i].near_next <= 1 and 0 <= rows[i].near_edited <= 1
    prints = defaultdict(set)
    for i, text in texts.items():
        prints[text].add(rows[i].fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_spot_signatures_of_odd_rows(spark, odd, none):
    rows = spotsigs.report(spotsigs.compared(odd)).collect()
    assert len(rows) == odd.count()
    assert spotsigs.report(spotsigs.compared(none)).count() == 0
    alone = spotsigs.report(spotsigs.compared(odd.filter("doc_id = 6"))).collect()
    assert alone[0].near_next == 1.0
    by = {r.doc_id: r for r in rows}
    # 4 is followed by the null text of 3; 13 and 12 are alike but for case.
    assert by[4].near_next == 1.0 and by[13].near_next == 1.0 and by[7].near_next < 1.0


def test_spot_signature_chains(spark):
    df = spark.createDataFrame([(1, "The cat and the dog sat on a mat quietly")], "doc_id long, text string")
    got = spotsigs.with_signatures(df, "text", "s").first().s
    chains = [("the\u0001 cat", "dog"), ("the\u0001 dog", "sat"), ("a\u0001 mat", "quietly")]
    want = spark.createDataFrame(chains, "a string, b string").selectExpr("xxhash64(a, b) h").collect()
    assert sorted(got) == sorted(r.h for r in want)


def test_similar_fingerprints_against_all_pairs(spark, docs):
    alike, member = spotsigs.similar_fingerprints(docs, 0.6)
    signed = spotsigs.with_signatures(docs, "text", "s").select("s").collect()
    sets = {frozenset(r.s) for r in signed if r.s}
    want = sorted(len(a & b) / len(a | b) for a in sets for b in sets if a is not b and len(a & b) >= 0.6 * len(a | b))
    got = sorted(r.likeness for r in alike.collect() for _ in range(2))
    assert len(want) > 0 and np.allclose(got, want) and member.count() == docs.count()
