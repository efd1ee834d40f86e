"""Source divergence, shards along a curve and collocations against plain versions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import collocations, hilbert_shards, source_divergence, vocabulary
from strataflow.llm.queries import ready

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, ordinal string, words string, size string, a string, bucket string, cell string, position string"
WORDS = ["the", "The", "of", "été", "Straße", "ÉTÉ", "don't", "a1b", "x\x01y", "ñu", "rain", "grey", "lake", "moss", "\U0001f30a", "日本"]


@pytest.fixture
def docs(spark, tmp_path):
    """Null in any column, empty and long texts, repeated rows, columns with names that operators use inside."""
    ready(spark)
    rng = random.Random(3)
    prose = lambda n: "".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b"]) for _ in range(n))
    made = [(i, prose(rng.choice([0, 3, 40, 90])), rng.choice(["en", "en", "fr", "", None]), rng.choice(["s1", "s2", "s10", "é", None])) for i in range(120)]
    made += [(None, None, "en", "s1"), (None, None, None, None), (7, "", "de", "only"), (8, "#1 2 3", "de", "none"), (9, "of the lake " * 3000, "en", "s1")]
    made += [made[3]] * 3 + [(200, "lone term", "it", "s1")]
    spark.createDataFrame([(*r, 5, *["x"] * 8) for r in made], SCHEMA).repartition(3).write.parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs"))


@pytest.fixture
def nothing(spark):
    ready(spark)
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# --- the vocabulary ------------------------------------------------------------------


def entries(seed=1, n=600):
    rng = random.Random(seed)
    return sorted({bytes(rng.choice(b"abc\xc3\xff\x00") for _ in range(rng.randint(0, 7))) for _ in range(n)})


def test_the_automaton_is_minimal_and_numbers_its_entries():
    words = entries()
    machine = vocabulary.minimal(words)
    # Two states of a minimal automaton differ in what they accept after them.
    rest = {}
    for state in range(len(machine.final)):
        low, high = np.searchsorted(machine.keys, [state << 8, (state + 1) << 8])
        after = {bytes([int(k) & 255]) + w for k, t in zip(machine.keys[low:high], machine.targets[low:high], strict=True) for w in rest[int(t)]}
        rest[state] = frozenset(after | ({b""} if machine.final[state] else set()))
    assert len(set(rest.values())) == len(rest) and rest[machine.root] == set(words)
    assert [machine.entry(i) for i in range(len(words))] == words
    same = vocabulary.Transducer.load(machine.dump())
    asked = words + [w + b"z" for w in words[:50]] + [b"zz", b"\xff\xff\xff\xff\xff\xff\xff\xff\xff"]
    data = np.frombuffer(b"".join(asked), np.uint8)
    ends = np.cumsum([len(w) for w in asked])
    known = {w: i for i, w in enumerate(words)}
    assert same.walk(data, ends - [len(w) for w in asked], ends).tolist() == [known.get(w, -1) for w in asked]
    empty = vocabulary.minimal([])
    assert empty.walk(data, np.array([0]), np.array([3])).tolist() == [-1]


@pytest.mark.parametrize("part_terms", [1, 7, 1 << 17])
def test_parts_number_pairs_in_order(spark, part_terms):
    ready(spark)
    rng = random.Random(2)
    pairs = sorted({(rng.choice(["", "de", "en", "é"]), bytes(rng.choice(b"ab\xc3") for _ in range(rng.randint(1, 12)))) for _ in range(200)}, key=lambda p: (p[0].encode() + b"\xff", p[1]))
    built = vocabulary.build(spark.createDataFrame([(a, bytearray(b)) for a, b in pairs], "lang string, term binary"), part_terms)
    assert [built.pair(i) for i in range(len(pairs))] == pairs
    for lang in ("", "de", "en", "é", "none"):
        asked = [b for _, b in pairs] + [b"nowhere"]
        data, ends = np.frombuffer(b"".join(asked), np.uint8), np.cumsum([len(w) for w in asked])
        known = {b: i for i, (a, b) in enumerate(pairs) if a == lang}
        assert built.ordinals(lang.encode(), data, ends - [len(w) for w in asked], ends).tolist() == [known.get(w, -1) for w in asked]


def test_long_texts_are_joined_piece_by_piece():
    cut = lambda text, at: found.start() if (found := re.compile(rb"[ ]").search(text, at)) else len(text)
    texts = [b"", b"one two three four five", b"x" * 40, b"a b", b""]
    words = [(k, w) for k, t in enumerate(texts) for w in t.split()]
    got = []
    for data, starts, owners in vocabulary.joined(texts, b" ", cut, most=8):
        for m in re.finditer(rb"[^ ]+", data):
            got.append((int(owners[np.searchsorted(starts, m.start(), side="right") - 1]), m[0]))
    assert got == words


# --- divergence of sources --------------------------------------------------------------


def plain_audit(rows, min_docs, top):
    docs = [(r.lang or "", r.source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(r.text or ""))) for r in rows]
    df = Counter((lang, w) for lang, _, words in docs for w in set(words))
    kept = defaultdict(list)
    for (lang, w), n in df.items():
        if n >= min_docs:
            kept[lang].append(w)
    counts = defaultdict(Counter)
    for lang, source, words in docs:
        counts[lang, source].update(w for w in words if w in set(kept[lang]))
    out = []
    for lang, source in counts:
        p = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept[lang])) for w in kept[lang]}  # noqa: B023, E731
        own, whole = p(counts[lang, source]), p(sum((c for (x, _), c in counts.items() if x == lang), Counter()))
        other = [(s, p(c)) for (x, s), c in counts.items() if x == lang and s != source]
        pairs = [(sum(abs(own[w] - q[w]) for w in kept[lang]), s) for s, q in other]
        terms = [(own[w] - whole[w], w) for w in kept[lang] if counts[lang, source][w] and own[w] > whole[w]]
        for part, items in (("pair", pairs), ("term", sorted(terms, key=lambda x: (-x[0], x[1].encode()))[:top])):
            out += [(lang, source, part, w, v, k) for k, (v, w) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode())), 1)]
    return sorted(out)


def audited(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergence(spark, docs, nothing, monkeypatch):
    for min_docs, top in ((2, 50), (9, 3), (1000, 50)):
        assert audited(source_divergence.audit(docs, min_docs, top)) == plain_audit(docs.collect(), min_docs, top)
    monkeypatch.setattr(source_divergence, "_BLOCK_ORDINALS", 2)
    monkeypatch.setattr(source_divergence, "_HELD_TERMS", 3)
    monkeypatch.setattr(source_divergence, "_HELD_COUNTS", 3)
    assert audited(source_divergence.audit(docs, 2)) == plain_audit(docs.collect(), 2, 50)
    assert source_divergence.audit(nothing).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    rng = random.Random(5)
    cases = [(n, n + rng.randint(5, 8 * 10**15 - n)) for n in (rng.randint(0, 4 * 10**15) for _ in range(200))]
    df = spark.createDataFrame(cases, "n long, t long").select(source_divergence.share("n", "t").alias("p"))
    exact = [1 + 10**9 * (n + 5) // t for n, t in cases]
    assert [r.p for r in df.collect()] == exact
    assert [int(source_divergence._shares(np.array([n]), np.array([t]))[0]) for n, t in cases] == exact


# --- shards along a curve ------------------------------------------------------------------


@pytest.mark.parametrize(("dimensions", "bits"), [(1, 3), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, dimensions, bits):
    path = [r.cell for r in hilbert_shards.curve(spark, dimensions, bits).orderBy("index").collect()]
    assert sorted(path) == list(range(1 << (dimensions * bits)))
    levels = [[(c >> (bits * k)) & ((1 << bits) - 1) for k in range(dimensions)] for c in path]
    assert all(sum(abs(x - y) for x, y in zip(a, b, strict=True)) == 1 for a, b in pairwise(levels))


def test_shards(spark, docs, nothing):
    rows = hilbert_shards.shards_of(docs).collect()
    given = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == given
    by_shard = defaultdict(list)
    for r in rows:
        assert (r.law, r.grown_shard) == ("rows", None)
        by_shard[r.shard].append(r.slot)
    assert set(by_shard) == set(range(24)) and {len(x) for x in by_shard.values()} <= {len(rows) // 24, len(rows) // 24 + 1}
    assert all(sorted(x) == list(range(len(x))) for x in by_shard.values())
    assert hilbert_shards.shards_of(nothing).count() == 0
    few = hilbert_shards.shards_of(docs.limit(5)).collect()
    assert len({r.shard for r in few}) == 5 and {r.slot for r in few} == {0}


def test_places_follow_the_curve(spark, docs):
    indexed = hilbert_shards.with_index(hilbert_shards.slim(docs), ("lang", "source"), ("size",))
    every = hilbert_shards.placed(hilbert_shards.slim(docs)).orderBy("shard", "slot").collect()
    known = defaultdict(set)
    for r in indexed.collect():
        known[r.lang, r.source, r.size].add(r.curve_index)
    assert all(len(x) == 1 for x in known.values())
    keys = [(r.curve_index, r.doc_id is not None, r.doc_id or 0) for r in every]
    assert keys == sorted(keys) and all(known[r.lang, r.source, r.size] == {r.curve_index} for r in every)
    # Levels keep the order of values, by rank among those that occur.
    langs = sorted({r.lang for r in every if r.lang is not None})
    levels = {r["_value"]: r["_level"] for r in hilbert_shards._text_levels(docs, "lang", 5).collect()}
    assert levels == {x: k * 32 // (len(langs) + 1) for k, x in enumerate([None, *langs])}


def test_one_hot_cell_is_dealt_over_tasks(spark):
    ready(spark)
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    ordered = hilbert_shards.with_index(hilbert_shards.slim(df), ("lang", "source"), ("size",)).repartitionByRange(8, "curve_index", "doc_id")
    held = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(held) == 8 and max(held) < 1500


def test_written_shards_are_pruned(spark, tmp_path):
    ready(spark)
    rng = random.Random(4)
    made = [(i, "w" * rng.randint(1, 3000), rng.choice(["de", "en", "fr", "es"]), f"src{rng.randint(10, 40)}") for i in range(2400)]
    spark.createDataFrame(made, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "in"))
    known = hilbert_shards.write(spark.read.parquet(str(tmp_path / "in")), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.text, r.lang, r.source) for r in back.collect()) == sorted(made)
    for asked, most in (({"lang": ("de", "de")}, 12), ({"source": ("src10", "src12")}, 14), ({"size": (0, 300)}, 14), ({"lang": ("fr", "fr"), "source": ("src38", "src40")}, 8)):
        shards = {r.shard for r in hilbert_shards.shards_meeting(known, **asked).collect()}
        inside = back.where(" AND ".join(f"{c} BETWEEN '{a}' AND '{b}'" if isinstance(a, str) else f"{c} BETWEEN {a} AND {b}" for c, (a, b) in asked.items()))
        assert {r.shard for r in inside.select("shard").distinct().collect()} <= shards and len(shards) <= most


# --- collocations ----------------------------------------------------------------------


def plain_mine(rows, least, top):
    counts, n = defaultdict(Counter), Counter()
    for r in rows:
        lang = "und" if r.lang is None else r.lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(r.text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            counts[lang].update(tuple(words[i : i + m]) for m in range(1, 6) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        often = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        inside = {w[i:j] for w in often for i in range(len(w)) for j in range(i + 2, len(w) + 1) if j - i < len(w) and often[w] >= f[w[i:j]]}
        found = []
        for w, a in often.items():
            score, k = min((1000 * a * n[lang] // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w)))
            if w not in inside:
                found.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        out += [(lang, rank, p.decode(), -a, x, y, n[lang], -s) for rank, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_collocations(docs, nothing, monkeypatch):
    for least, top in ((2, 2000), (12, 5), (100, 2000)):
        assert mined(collocations.mine(docs, least, top)) == plain_mine(docs.collect(), least, top)
    assert collocations.mine(docs, 10**6).count() == 0
    assert collocations.mine(nothing).count() == 0
    # Many ranges cut through runs, small holds and batches too.
    monkeypatch.setattr(collocations, "width_for", lambda df: 40)
    monkeypatch.setattr(collocations, "_HELD_WORDS", 5)
    assert mined(collocations.mine(docs, 3)) == plain_mine(docs.collect(), 3, 2000)


def test_runs_across_batches_and_ranges(spark, docs, conf):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="3")
    assert mined(collocations.mine(docs, 5)) == plain_mine(docs.collect(), 5, 2000)


def test_windows_of_a_buffer():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 200):
        ordinals, together = rng.integers(-1, 6, size), rng.random(max(size - 1, 0)) < 0.8
        rows, counts = collocations.windows(ordinals, together)
        plain = Counter()
        for i in range(size):
            w = []
            while len(w) < 5 and i + len(w) < size and ordinals[i + len(w)] >= 0 and (not w or together[i + len(w) - 1]):
                w.append(int(ordinals[i + len(w)]) + 1)
            if w:
                plain[tuple(w + [0] * (5 - len(w)))] += 1
        got = [tuple(map(int, r)) for r in rows]
        assert got == sorted(plain) and dict(zip(got, counts.tolist(), strict=True)) == plain


def test_streams_meet_by_merge_joins(docs):
    plan = collocations.mine(docs, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 3 and "ShuffledHashJoin" not in plan


def test_scores_beyond_64_bits(spark):
    a, n = 9 * 10**14, 8 * 10**15
    df = spark.sql(f"SELECT {a}L AS a, {n}L AS n, {a}L + 7 AS l, {n}L - 11 AS r").select(collocations.score().alias("s"))
    assert df.first().s == 1000 * a * n // ((a + 7) * (n - 11))
