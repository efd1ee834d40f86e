"""Each operator against a brute-force version, with nulls, empty and long texts, ties, repeats, clashing columns and empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import (
    bpe_codec,
    bpe_text,
    packing_gga,
    paragraph_dedup,
    pii,
    quality_qda,
    quality_rules,
    simhash_anchor,
    suffix_dedup,
    token_binary,
    topk_nra,
)
from strataflow.llm.common import stored
from strataflow.llm.components import components
from strataflow.llm.queries import ready

SCHEMA = "doc_id long, text string, lang string, chunk string, fp string, root string, row string, fold string, _score string, bucket string"
WORDS = ["the", "of", "anon", "therein", "été", "straße", "don't", "we'll", "a1", "42", "…", "ñu", "rain", "grey", "lake", "stone", "moss"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "a", "en", "ly"]) for _ in range(n))


def texts():
    rng = random.Random(7)
    shared = prose(rng, 60)
    made = [None, "", "  \n\t ", "one", "x" * 60, shared, shared, f"{prose(rng, 30)}\n{shared}\n{prose(rng, 5)}", prose(rng, 4000)]
    made += ["mail me@you.example.org or +49 (30) 123-4567, 4111 1111 1111 1111 from 10.0.0.255", "4" * 5000 + " 1.2.3.999", "#$% | | <b>"]
    made += [prose(rng, 40) + "\n" + prose(rng, 3) for _ in range(12)]
    made += [" ".join(made[-1].split()[:-1]) + " changed", "the rain " * 30]
    return made


@pytest.fixture
def docs(spark, tmp_path):
    """Ids descend, one is null, one is there twice; every other column's name is one that operators use inside."""
    ready(spark)
    made = texts()
    data = [(500 - i, t, *["x"] * 8) for i, t in enumerate(made)] + [(None, made[5], *["x"] * 8), (7, made[8], *["x"] * 8), (7, "twice", *["x"] * 8)]
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs"))


@pytest.fixture
def nothing(spark):
    ready(spark)
    return spark.createDataFrame([], SCHEMA)


def pairs(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def labels_of(docs):
    return docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# --- personal data ---------------------------------------------------------------


def every_segmentation(n, segments):
    """All ways to place segments on n tokens without overlap, as lists of their numbers."""
    if n == 0:
        return [[]]
    out = every_segmentation(n - 1, segments)
    for k, (i, j) in enumerate(segments):
        if j == n - 1:
            out = out + [[*rest, k] for rest in every_segmentation(i, segments)]
    return out


def test_field_against_enumeration():
    rng = np.random.default_rng(3)
    for text in ("a1 @b", "+1 2-3", "x@y.z 7", "1.2.3"):
        lattice = pii._Lattice(text, 0, len(text))
        w = rng.normal(size=(pii.N_FEATURES, 4))
        scores = lattice.x @ w
        ways = every_segmentation(len(lattice.bounds), lattice.segments)
        labelled = [[(k, c) for k, c in zip(way, kinds, strict=True)] for way in ways for kinds in np.ndindex(*[4] * len(way))]
        total = np.array([sum(scores[k, c] for k, c in way) for way in labelled])
        expected = np.zeros_like(scores)
        chance = np.exp(total - np.logaddexp.reduce(total))
        for p, way in zip(chance, labelled, strict=True):
            for k, c in way:
                expected[k, c] += p
        counts, log_z = lattice.gradient(scores)
        assert np.allclose(counts, expected) and np.isclose(log_z, np.logaddexp.reduce(total))
        best = labelled[int(total.argmax())]
        spans = [(lattice.bounds[lattice.segments[k][0]][0], lattice.bounds[lattice.segments[k][1]][1], c) for k, c in best]
        assert pii.best_spans(text, 0, len(text), w) == spans


def test_zeros_beyond_what_int_reads():
    text = "0" * 5000 + ".1.1.1 and " + "0" * 5000 + "1.2.3.4 and 1.1.1." + "0" * 5000 + "256"
    spans = pii.base_spans(text)
    assert [(e - s, k) for s, e, k in spans] == [(5006, 1), (5007, 1)]
    assert pii.all_spans(text, np.zeros((pii.N_FEATURES, 4)) - 1, spans) == spans


def test_spans_at_every_place_of_a_long_stretch(monkeypatch):
    w = np.zeros((pii.N_FEATURES, 4))
    w[0], w[7, 1], w[8, 1] = -1, 2, 2  # four groups of digits with dots alone are worth a segment
    for tokens in (0, 1, 395, 398, 399, 400, 401, 1999):
        lead = "7 " * (tokens // 2) + "7" * (tokens % 2)
        text = f"{lead}{' ' if tokens % 2 else ''}10.20.30.40" + " 8" * 600
        at = text.index("10.20")
        assert pii.best_spans(text, 0, len(text), w) == [(at, at + 11, 1)]


def test_a_field_is_fitted_where_there_are_digits_only(spark):
    ready(spark)
    df = spark.createDataFrame([(i, f"from 10.0.{i}.1 to 4111 1111 1111 1111 in {i} steps") for i in range(30)], "doc_id long, text string")
    assert pii.train(df) is not None

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def plain_spans(t):
    out = [(*m.span(), 0) for m in EMAIL.finditer(t)]
    out += [(*m.span(), 1) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == 3 or pii.luhn(digits)):
                out.append((*m.span(), kind))
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(1)
    for _ in range(8000):
        t = "".join(rng.choice("a1@.+ -(5)2\n") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == plain_spans(t)
    # Of two spans with one start the kind decides, not the end.
    assert pii.joined([(0, 9, 1), (0, 5, 3)]) == "ip:0:9,phone:0:5"


def test_field_learns_base_spans_and_adds_none_over_them():
    rng = random.Random(3)
    made = [f"x {rng.randint(1, 255)}.{rng.randint(0, 255)}.7.{rng.randint(0, 255)} y" for _ in range(20)]
    made += [f"x {rng.choice('abc')}n.{i}@mail{i}.example.com y" for i in range(20)] + [f"x +1 (736) 555-{1000 + i} y" for i in range(20)] + ["x 2.0. y", "x 17 y"] * 5
    weights = pii.fit([(t, pii.base_spans(t)) for t in made])
    hidden = [pii.best_spans(t, 2, len(t) - 2, weights) for t in made]
    assert sum(h == pii.base_spans(t) for h, t in zip(hidden, made)) >= 0.95 * len(made)
    for t in made:
        assert set(pii.base_spans(t)) <= set(pii.all_spans(t, weights, pii.base_spans(t)))


def test_long_stretches_are_scored_in_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    text = " ".join(f"{i % 97}-{i % 13}" for i in range(900))
    weights = rng.normal(size=(pii.N_FEATURES, 4)) + 0.5
    found = pii.best_spans(text, 0, len(text), weights)
    assert found
    for size in (1, 23, 10**6):
        monkeypatch.setattr(pii, "_BLOCK_TOKENS", size)
        assert pii.best_spans(text, 0, len(text), weights) == found
    assert pii.all_spans(text, np.zeros((pii.N_FEATURES, 4)) - 1, []) == []


def test_pii_rows(docs, nothing):
    want = []
    for d, t in pairs(docs):
        spans = plain_spans(t)
        want.append((d, *(sum(k == x for *_, k in spans) for x in range(4)), hashlib.sha256(pii.joined(spans).encode()).hexdigest()))
    found = pii.find(docs)
    assert got(found, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(want, key=repr)
    assert pii.find(nothing).count() == 0
    masked = pii.mask(docs)
    assert masked.columns == docs.columns and masked.where("text IS NULL").count() == docs.where("text IS NULL").count()
    assert "<email>" in masked.where("text LIKE 'mail %'").first().text and "@" not in masked.where("text LIKE 'mail %'").first().text


# --- quality ---------------------------------------------------------------------


def test_discriminant_tells_classes_apart_on_held_out_rows(spark):
    ready(spark)
    rng = random.Random(5)
    data = [(i, prose(rng, 80) if i % 2 else "spam " * 40 + prose(rng, 20), i % 2) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in data] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality_qda.classify(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.predicted == r.doc_id % 2 for r in rows if r.held_out)
    kept = quality_qda.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 300


def test_discriminant_without_labels_or_documents(docs, nothing):
    rows = quality_qda.classify(docs, labels_of(nothing)).collect()
    assert {r.score for r in rows} == {0.5} and len(rows) == docs.count()
    assert quality_qda.classify(nothing, labels_of(nothing)).count() == 0
    assert quality_qda.keep_good(docs, labels_of(docs)).columns == docs.columns


def plain_counts(t):
    words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
    at, covered = {}, set()
    for k in range(len(words) - 7):
        at.setdefault(tuple(words[k : k + 8]), []).append(k)
    for places in at.values():
        if len(places) > 1:
            covered |= {j for k in places for j in range(k, k + 8)}
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n = len(words)
    return n, sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n


def test_rules_count_exactly(docs, nothing):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    judged = quality_rules.judge(docs, labels_of(docs))
    assert got(judged, *columns) == sorted(((d, *plain_counts(t)) for d, t in pairs(docs)), key=repr)
    assert judged.where("kept AND base_failed").count() == 0
    assert quality_rules.judge(nothing, labels_of(nothing)).count() == 0
    assert "Python" not in judged._jdf.queryExecution().executedPlan().toString()


def test_tail_is_the_binomial_distribution(spark):
    from math import comb

    df = spark.createDataFrame([(x, n) for n in (5, 50, 400) for x in (0, 1, 4)], "x long, n long")
    for r in df.select("x", "n", quality_rules._tail(F.col("x"), F.col("n"), 0.02).alias("p")).collect():
        assert r.p == pytest.approx(sum(comb(r.n, i) * 0.02**i * 0.98 ** (r.n - i) for i in range(r.x + 1)), rel=1e-9)


def test_rules_together_reject_no_more_than_the_risk(spark):
    """Four rules that each reject other good documents, 8 of 1,000: any one alone is within 1 %, together they are not. With 1 of 1,000 each they are."""
    ready(spark)
    for share, admitted in ((8, set()), (1, {"repeats", "lines", "symbols", "long_words"})):
        hit = lambda k, bad, well: F.when(F.floor(F.col("doc_id") % 1000 / share) == k, bad).otherwise(well).cast("long")  # noqa: B023, E731
        counts = spark.range(30_000).toDF("doc_id").select(
            "doc_id", F.lit(200).cast("long").alias("n_words"), hit(3, 4000, 1000).alias("word_chars"), hit(2, 300, 0).alias("n_symbols"), hit(1, 60, 0).alias("n_dup_lines"),
            hit(0, 40, 0).alias("n_repeat_words"), F.lit(100).cast("long").alias("n_lines"), F.lit(False).alias("base_failed"),
        )
        found = quality_rules.thresholds(counts, counts.select("doc_id", F.lit(1).alias("quality")), 0.01, 0.05).collect()
        assert {r.rule for r in found} - {"few_words"} == admitted


def plain_thresholds(rows, risk, level):
    """stratum -> rule -> cutoff, from (doc_id, n_words, statistics by rule) of good documents that pass the base rule."""
    from math import comb

    rules, strata = quality_rules.RULES, len(quality_rules.STRATA) + 1
    cuts = {r: sorted((quality_rules._cut(r, v) for v in values), reverse=True) for r, values in rules.items()}  # from mild to strict
    out = {}
    for stratum in range(strata):
        own = [(d, s) for d, n, s in rows if sum(n >= x for x in quality_rules.STRATA) == stratum]
        halves = [[s for d, s in own if zlib.crc32(str(d).encode()) % 2 == h] for h in (0, 1)]
        upto = {r: sum(sum(s[r] >= cuts[r][t] for s in halves[0]) <= risk / len(rules) * len(halves[0]) for t in range(4)) for r in rules} if halves[0] else {}
        upto = {r: t for r, t in upto.items() if t}
        step, n = 0, len(halves[1])
        while upto and n and step < 4:
            x = sum(any(s[r] >= cuts[r][min(step, t - 1)] for r, t in upto.items()) for s in halves[1])
            if x >= risk * n or sum(comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(x + 1)) > level / strata:
                break
            step += 1
        if step:
            out[stratum] = {r: cuts[r][min(step, t) - 1] for r, t in upto.items()}
    return out


def test_thresholds_and_verdict_against_a_plain_version(spark, tmp_path):
    ready(spark)
    rng = random.Random(8)
    data = []
    for i in range(6000):
        n = rng.choice([60, 200, 700]) + rng.randint(0, 30)
        rare = lambda p, hi: rng.randint(1, hi) if rng.random() < p else 0  # noqa: B023, E731
        data.append((i, n, n * rng.choice([4, 5, 6]) + rare(0.002, 9000), rare(0.01, 40), rare(0.004, 30), rare(0.01, n // 3), 50, False))
    counts = spark.createDataFrame(data, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, base_failed boolean")
    counts.write.parquet(str(tmp_path / "counts"))
    counts = spark.read.parquet(str(tmp_path / "counts"))
    stats = lambda r: {"repeats": 100 * r[5] // r[1], "lines": 100 * r[4] // r[6], "symbols": 1000 * r[3] // r[2], "long_words": 100 * r[2] // r[1], "few_words": -r[1]}
    good = [(r[0], r[1], stats(r)) for r in data if r[0] % 3]
    labels = spark.createDataFrame([(r[0], int(r[0] % 3 > 0)) for r in data] + [(None, 1), (9, None)], "doc_id long, quality int")
    for risk in (0.01, 0.03):
        want = plain_thresholds(good, risk, 0.05)
        found = {}
        for r in quality_rules.thresholds(counts, labels, risk, 0.05).collect():
            found.setdefault(r.stratum, {})[r.rule] = r.cutoff
        assert found == want
    assert any(len(x) > 1 for x in want.values())


# --- byte-level BPE ----------------------------------------------------------------


def test_pre_tokens_are_those_of_the_pattern():
    import public_tokenizers
    import regex

    pattern, rng = regex.compile(public_tokenizers.PATTERN), random.Random(2)
    for _ in range(3000):
        made = ["".join(rng.choice(" '\n\tstrevlmda1.É ñ! ") for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 5))]
        split = bpe_text.Split(made)
        assert [split.words[k] for k in split.which] == [x for t in made for x in pattern.findall(t)]


def test_every_code_point_is_split_as_by_the_library():
    """Each between letters and after a digit, also those newer than Python's Unicode version; the other planes hold no characters."""
    name = "byte_bpe_multi_50k.tiktoken"
    whole = bpe_text._encoder(name)
    for plane in (0, 1, 2, 3, 14):
        made = [f"x{chr(c)}y 7{chr(c)}" for c in range(max(128, plane << 16), (plane + 1) << 16) if not 0xD800 <= c < 0xE000]
        split = bpe_text.Split(made, by_library=True)
        ids = bpe_text.encode_words(split.words, name)
        ends = np.cumsum(split.counts).tolist()
        got = [[i for k in split.which[a:b].tolist() for i in ids[k]] for a, b in zip([0, *ends], ends, strict=False)]
        assert got == whole.encode_ordinary_batch(made, num_threads=8)


def test_round_trip_is_what_the_library_gives(docs, nothing):
    encode = bpe_text._encoder("byte_bpe_multi_50k.tiktoken").encode_ordinary
    want = []
    for d, t in pairs(docs):
        ids = encode(t)
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got(bpe_codec.round_trip(docs, "byte_bpe_multi_50k.tiktoken"), *columns) == sorted(want, key=repr)
    assert bpe_codec.round_trip(nothing, "byte_bpe_multi_50k.tiktoken").count() == 0


def library_ids(t):
    return bpe_text._model("byte_bpe_50k.json").encode(t, add_special_tokens=False).ids


def test_added_tokens_are_those_of_the_library(tmp_path):
    import json

    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    with open(file) as f:
        made = json.load(f)
    flags = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}
    extra = [("<|end", {}), ("<l>", {"lstrip": True}), ("<r>", {"rstrip": True}), ("cat", {"single_word": True}), ("<n>", {"normalized": True}), ("a<n>b", {"normalized": True, "lstrip": True, "rstrip": True})]
    made["added_tokens"] += [{"id": 50257 + k, "content": c, **flags, **own} for k, (c, own) in enumerate(extra)]
    other = tmp_path / "other.json"
    other.write_text(json.dumps(made))
    rng = random.Random(6)
    pieces = ["<|endoftext|>", "<|end", "<|endoftext|", "<l>", "<r>", "cat", "<n>", "a<n>b", "it's", "'s", " ", "  ", "\n", "\u00a0", "_", "é", "\u0301", "x1", "."]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(1500)] + ["a <|endoftext|> b", "<|endoftext|>" * 3, ""]
    for name in ("byte_bpe_50k.json", str(other)):
        library = Tokenizer.from_file(file if name == "byte_bpe_50k.json" else name)
        encode = bpe_text.Encoder(name)
        for at in range(0, len(texts), 50):
            want = [library.encode(t, add_special_tokens=False).ids for t in texts[at : at + 50]]
            ids, sizes = encode(texts[at : at + 50])
            assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for x in want for i in x]
    assert bpe_text.Encoder("byte_bpe_50k.json")(["a <|endoftext|> b"])[0].tolist() == [64, 220, 50256, 275]
    assert [x.tolist() for x in bpe_text.Encoder("byte_bpe_50k.json")(["<|endoftext|>"])] == [[50256], [1]]


def test_elias_fano_selects_what_it_was_given():
    rng = np.random.default_rng(4)
    for n, top in ((0, 1), (1, 1), (5, 3), (1000, 10), (1000, 10**9), (3000, 2**40)):
        values = np.sort(rng.integers(0, top, n))
        sequence, _ = token_binary.EliasFano.load(memoryview(token_binary.EliasFano.of(values).dump()), 0)
        assert sequence.all().tolist() == values.tolist()
        assert [sequence.select(i) for i in range(0, n, 7)] == values[::7].tolist()
    spaced = token_binary.EliasFano.of(np.arange(10_000) * 1000)
    assert 8 * len(spaced.dump()) < 10_000 * (2 + np.log2(1000) + 1.5) + 400


def test_words_seen_again_are_not_encoded_again(monkeypatch):
    """Also past the bound of what is remembered; rare words make room."""
    asked, encode_words = [], bpe_text.model_encode_words
    monkeypatch.setattr(bpe_text, "model_encode_words", lambda words, name: asked.extend(words) or encode_words(words, name))
    encode = bpe_text.Encoder("byte_bpe_50k.json", remember=40)
    for n in range(30):
        made = ["rain straße " + " ".join(f"q{n}x{k}é" for k in range(9)), "", "rain"]
        ids, counts = encode(made)
        want = [library_ids(t) for t in made]
        assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))
    assert asked.count("rain") == asked.count(" straße") == 1
    assert len(encode.known.names) + len(encode.before.names) < 100


@pytest.mark.parametrize("by_code", [np.ones(0x110000, np.uint64), np.arange(0x110000, dtype=np.uint64) // 2])
def test_words_that_share_a_name_are_kept_apart(monkeypatch, by_code):
    monkeypatch.setattr(bpe_text, "_factors", lambda: (by_code, np.ones(256, np.uint64)))
    encode = bpe_text.Encoder("byte_bpe_50k.json")
    for made in (["bc", "lake"], ["cb"], ["bc cb bb", "ekal"], ["cc"]):
        assert encode(made)[0].tolist() == [i for t in made for i in library_ids(t)]


def test_token_files(docs, nothing):
    rows = token_binary.write_and_read(docs, "byte_bpe_50k.json").collect()
    ids = {}
    for d, t in pairs(docs):
        own = [*library_ids(t), 0]
        ids.setdefault(d, []).append((len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and (r.n_tokens, r.ids_crc32) in ids[r.doc_id]
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0)) and len(rows) == docs.count()
    assert token_binary.write_and_read(nothing, "byte_bpe_50k.json").count() == 0


def test_packing_holds_every_piece_once(docs, nothing):
    rows = packing_gga.pack_documents(docs, "byte_bpe_50k.json", size=64).collect()
    want = []
    for d, t in pairs(docs):
        ids = [*library_ids(t), 2]
        cuts = [0, *range((len(ids) - 1) % 64 + 1, len(ids) + 1, 64)]
        want += [(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *(n for _, n in own[:-1])]).tolist() and sum(n for _, n in own) <= 64
    assert len(places) <= -(-sum(w[3] for w in want) // 64) + 2
    assert packing_gga.pack_documents(nothing, "byte_bpe_50k.json").count() == 0


def test_a_child_keeps_every_item_once():
    rng = random.Random(6)
    sizes = [rng.randint(1, 60) for _ in range(300)]
    a, b = (packing_gga.best_fit(rng.sample(range(300), 300), sizes, 100, []) for _ in range(2))
    for _ in range(20):
        made = packing_gga.child(a, b, sizes, 100, rng)
        assert sorted(i for x in made for i in x) == list(range(300)) and max(sum(sizes[i] for i in x) for x in made) <= 100
        a, b = made, a
    best = packing_gga.evolve(sizes, 100, 1, [])[0]
    assert len(best) <= -(-sum(sizes) // 100) + 1


# --- search ------------------------------------------------------------------------


def test_top_k_is_exact(spark, nothing):
    rng = np.random.default_rng(8)
    vectors = [(i, rng.normal(size=6).round(1).tolist(), 0) for i in range(0, 900, 3)]
    vectors += [(900, [0.0] * 6, 1), (901, None, 0), (902, [1.0, None] * 3, 0), (903, [float("nan")] * 6, 0), (904, [], 0), (905, [9.0] * 2, 0), (3, vectors[1][1], 0), (None, [1.0] * 6, 0)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, rank int")
    fine = [(i, np.floor(np.array(v, np.float32).astype(float) * 1024).astype(int)) for i, v, _ in vectors if i is not None and v and None not in v and np.isfinite(v).all()]
    want = []
    for q in {i: v for i, v in fine if i % 100 == 0}.items():
        scores = sorted(((-int(q[1] @ v), i) for i, v in fine if i != q[0] and len(v) == len(q[1])))[:10]
        want += [(q[0], k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert got(topk_nra.top_k(df), "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)
    assert topk_nra.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# --- duplicates --------------------------------------------------------------------


def test_suffix_dedup_against_all_strings(docs, nothing, monkeypatch):
    want = []
    every = [(1 << 62 if d is None else d, d, t.encode()) for d, t in pairs(docs)]
    for key, d, raw in every:
        smaller = {x[p : p + 50] for k, _, x in every if k < key for p in range(len(x) - 49)}
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if raw[p : p + 50] in smaller:
                gone[p : p + 50] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        want.append((d, len(raw), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(suffix_dedup.digest(docs), *columns) == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 500
    assert suffix_dedup.digest(nothing).count() == 0
    kept = suffix_dedup.keep_text(docs)
    assert kept.columns == docs.columns and kept.where("text IS NULL").count() == 1


def test_cover_meets_every_pair_of_positions():
    for i in range(suffix_dedup.PERIOD):
        for j in range(suffix_dedup.PERIOD):
            assert any((i + k) % 21 in suffix_dedup.COVER and (j + k) % 21 in suffix_dedup.COVER for k in range(21))


def test_anchors_meet_every_near_half():
    rng = np.random.default_rng(9)
    halves = rng.integers(0, 1 << 32, 300, dtype=np.uint32)
    home, near = simhash_anchor.anchors_of(halves)
    assert (np.bitwise_count(home ^ halves) <= 1).all() and (np.bitwise_count(near ^ halves[:, None]) <= 2).all()
    for bit in range(32):
        _, others = simhash_anchor.anchors_of(halves ^ np.uint32(1 << bit))
        assert (others == home[:, None]).any(1).all()


def test_simhash_components(docs, nothing, spark, monkeypatch):
    monkeypatch.setattr(simhash_anchor, "BLOCK", 2)  # every group is compared block by block
    rows = simhash_anchor.near_duplicates(docs).collect()
    every = pairs(docs)
    prints = [simhash_anchor.fingerprint_of(t) & (1 << 64) - 1 for _, t in every]
    root = list(range(len(every)))
    for i in range(len(every)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root = [root[i] if r == root[j] else r for r in root]
    least = {}
    for (d, _), r in zip(every, root):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    want = sorted(((d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(every, prints, root)), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in rows), key=repr) == want
    assert simhash_anchor.near_duplicates(nothing).count() == 0
    kept = simhash_anchor.keep_first(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_fingerprint_is_the_majority_of_shingle_hashes():
    import xxhash

    for t in ("", "A", "a b", "A b\tc d\n d", "x y z " * 9):
        words = t.lower().split()
        shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash_anchor.fingerprint_of(t) & (1 << 64) - 1 == want


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 2000 + i) for i in range(50)] + [(5, 5), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 1000: 1000, **{2000 + i: 1000 for i in range(50)}}


def test_paragraph_dedup_against_all_pairs(docs, nothing):
    order = sorted(enumerate(pairs(docs)), key=lambda x: (x[1][0] is None, x[1][0] or 0))
    units = [(d, b" ".join(words)) for _, (d, t) in order for _, words, _ in paragraph_dedup._pieces(t)]
    distinct = list(dict.fromkeys(p for _, p in units))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (p.split(b" ") for p in distinct)]
    root = list(range(len(distinct)))
    for i in range(len(sets)):
        for j in range(i):
            if root[i] != root[j] and paragraph_dedup.similar(sets[i], sets[j], 0.8):
                root = [root[i] if r == root[j] else r for r in root]
    seen, removed = set(), {}
    for d, p in units:
        r = root[distinct.index(p)]
        removed[d] = removed.get(d, 0) + (r in seen)
        seen.add(r)
    rows = paragraph_dedup.cut_paragraphs(docs).collect()
    assert {r.doc_id: r.n_removed for r in rows} == {d: removed.get(d, 0) for d, _ in pairs(docs)}
    assert sum(removed.values()) > 3
    assert paragraph_dedup.cut_paragraphs(nothing).count() == 0


def test_short_lines_are_compared(spark):
    """Lines of raw texts against all others; a line of under five words is alike to the same one only."""
    ready(spark)
    rng = random.Random(3)
    plain = [f"w{i}" for i in range(400)]
    verse = "\n".join(" ".join(rng.choices(plain, k=rng.randint(1, 9))) for _ in range(12))
    made = [verse, f"own {' '.join(rng.choices(plain, k=6))}\n{verse}", "All rights reserved.\n \n}", "}\nAll  rights reserved.\nelse", "one", "one", "two", ""]
    made += ["a b c d e f g h i", "a b c d e f g h", "a b c d", "b a c d"]
    units = [(d, tuple(line.split())) for d, t in enumerate(made) for line in t.split("\n") if line.split()]
    sets = [{w[i : i + 5] for i in range(len(w) - 4)} or {w} for _, w in units]
    root = list(range(len(units)))
    for i in range(len(units)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [root[i] if r == root[j] else r for r in root]
    want = {d: [0, 0] for d in range(len(made))}
    for k, (d, _) in enumerate(units):
        want[d][0] += 1
        want[d][1] += root[k] in root[:k]
    rows = paragraph_dedup.cut_paragraphs(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")).collect()
    assert {r.doc_id: [r.n_paragraphs, r.n_removed] for r in rows} == want
    assert want[1][1] == 12 and want[3][1] == 2 and want[5][1] == 1 and want[9][1] == 1


def test_passages_are_found_in_own_and_longer_lines(spark):
    """Passages of 51 to 150 words, raw texts: the later document is linked to the first, and most of the passage's words are in common pieces."""
    ready(spark)
    rng = random.Random(4)
    made, lengths = [], []
    word = lambda: f"w{rng.randrange(10**6)}"
    for n in (51, 55, 60, 64, 65, 80, 100, 150) * 8:
        passage = " ".join(word() for _ in range(n))
        around = [" ".join(word() for _ in range(rng.randint(5, 90))) for _ in range(4)]
        first = passage if len(lengths) % 2 else f"{around[0]} {passage} {around[1]}"
        made += [first, f"{around[2]} {passage} {around[3]}"]
        lengths.append(n)
    # 50 of 60 words in common: Jaccard 0.70 as lines.
    common = " ".join(word() for _ in range(50))
    made += [common + "".join(" " + word() for _ in range(10)) for _ in range(2)]
    rows = {r.doc_id: r for r in paragraph_dedup.cut_paragraphs(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")).collect()}
    assert all(rows[d].first_ids == ([d - 1] if d % 2 else []) for d in range(len(made)))
    for k, n in enumerate(lengths):
        held = [{b" ".join(words) for _, words, _ in paragraph_dedup._pieces(made[2 * k + i])} for i in range(2)]
        assert all(x in made[2 * k].encode() for x in held[0])
        assert sum(len(x.split()) for x in held[0] & held[1]) >= 0.25 * n
    assert sum(rows[d].n_removed for d in range(1, len(made), 2)) > 200


def test_a_released_write_leaves_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (found.apply(k).getName() for k in range(found.size())) if n.startswith("shuffle_")}

    before = files()
    counted = spark.range(20_000).groupBy((F.col("id") % 9_000).alias("k")).count()
    held = stored(counted, "released", release=True)
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before and held.count() == 9_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_buckets_with_the_same_paragraphs_are_compared_once(spark):
    held = {1: [10, 11], 2: [11, 10], 3: [10, 12], 4: [10, 11, 12], 5: range(300), 6: range(300), 7: range(1, 301)}
    near = spark.createDataFrame([(pid, key) for key, pids in held.items() for pid in pids], "pid long, key long")
    assert sorted(map(tuple, paragraph_dedup._buckets(near).collect())) == [(1, 1), (3, 1), (4, 1), (5, 3), (7, 3)]


def test_lines_with_a_word_changed_stay_linked(spark):
    """As whole lines, whatever their length: Jaccard of 0.8 and more between lines, with the change amid them."""
    ready(spark)
    rng = random.Random(5)
    made = []
    for n in (49, 56, 64, 90, 300):
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        made += [" ".join(words), " ".join([*words[: n // 2], "changed", *words[n // 2 + 1 :]])]
    lines = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    found = {frozenset((r.a, r.b)) for r in paragraph_dedup.links(lines).collect()}
    for a, b in zip(made[::2], made[1::2], strict=True):
        assert frozenset(paragraph_dedup._pid(x.encode().split()) for x in (a, b)) in found


def test_few_shingles_must_be_the_same():
    for s in (0.5, 0.8, 0.9):
        n = paragraph_dedup.few(s)
        assert not paragraph_dedup.similar(set(range(n)), set(range(n + 1)), s)
        assert paragraph_dedup.similar(set(range(n + 1)), set(range(n + 2)), s)


def test_bit_planes_come_back():
    from strataflow.llm.common import bit_planes, from_bit_planes

    rng = np.random.default_rng(10)
    for bits in (1, 7, 8, 31, 54, 64):
        for n in (0, 1, 13):
            values = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            kept = values & np.uint64((1 << bits) - 1)
            assert from_bit_planes(bit_planes(values, bits), bits, n).tolist() == kept.tolist()


def test_names_wider_than_a_word(docs, monkeypatch):
    plain = got(suffix_dedup.digest(docs), "doc_id", "kept_sha256")
    monkeypatch.setattr(suffix_dedup, "_name_bits", lambda total, buckets: 83)
    assert got(suffix_dedup.digest(docs), "doc_id", "kept_sha256") == plain
