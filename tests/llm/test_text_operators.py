"""Line dedup, SimHash, quality rules, toxicity and packing."""

import random
import time
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from duebook.llm import packing, quality, simhash, toxicity
from duebook.llm.common import Scratch
from duebook.llm.components import components
from duebook.llm.line_dedup import line_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, row string, lines_removed int, label int, _key int"
LONG = "\n".join(f"line {i % 700} of a very long text {i % 700}" for i in range(6000))


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns."""
    texts = {1: "a b c\nd e f\ng h i\nj", 2: None, 3: "", 4: " \n\t\n ", 5: "x", 6: LONG, 7: "a b c\n\nd e f\ng h i\nk", 8: "a b c\nd e f\ng h i\nj", None: "a b c\nd e f\ng h i\nz"}
    rows = [(i, t, None, "s" if (i or 0) % 2 else None, None, "h", "r", 5, None, 1) for i, t in texts.items()]
    return [*rows, rows[0], rows[0], (None, None, *rows[0][2:])]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def random_docs(seed, n=60):
    rng = random.Random(seed)
    passage = [[f"p{k} {i} common line" for i in range(5)] for k in range(3)]
    docs = []
    for i in range(n):
        lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 7))) for _ in range(rng.randint(0, 9))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(lines))
            lines[at:at] = rng.choice(passage)
        if rng.random() < 0.3:
            lines += lines[:4]
        docs.append((i * 3 + 1, "\n".join(lines)))
    return docs


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7)]
    df = spark.createDataFrame(pairs, "a long, b long")
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    want = brute.groups(pairs, nodes)
    assert {r.node: r.root for r in components(df, "a", "b").collect()} == want
    assert components(df.limit(0), "a", "b").count() == 0


def test_line_dedup_against_brute_force(spark):
    for seed in (1, 2):
        docs = random_docs(seed)
        got = line_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
        assert {r.doc_id: (r.text, r.lines_removed) for r in got.collect()} == brute.line_dedup(docs)


def test_line_dedup_of_odd_rows(spark, odd, none):
    got = line_dedup(odd)
    assert got.columns == [c for c in odd.columns if c != "lines_removed"] + ["lines_removed"]
    rows = [(r.doc_id, r.text, r.lines_removed) for r in got.collect()]
    assert len(rows) == len(odd_rows())
    assert rows.count((1, "a b c\nd e f\ng h i\nj", 0)) == 3  # rows of one id do not remove each other's lines
    assert (2, None, 0) in rows and (3, "", 0) in rows and (4, " \n\t\n ", 0) in rows and (5, "x", 0) in rows
    assert (7, "k", 3) in rows and (8, "", 4) in rows  # blank lines between covered ones go
    assert (None, "z", 3) in rows and (None, None, 0) in rows  # rows without an id come last
    assert next(r for r in rows if r[0] == 6)[1:] == ("\n".join(LONG.split("\n")[:700]), 5300)
    assert line_dedup(none).count() == 0


def test_links_lose_none(spark):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(120)}
    for p in list(prints):
        q = p
        for b in rng.sample(range(64), rng.randint(1, 5)):
            q ^= 1 << b
        prints.add(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    for distance in (0, 1, 3, 4):
        got = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in simhash.links(df, distance).collect()}
        want = {frozenset((p, q)) for p in prints for q in prints if 0 < (p ^ q).bit_count() <= distance}
        assert got == want


def test_simhash_against_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(70):
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.choice((0, 1, 2, 40, 90))))
        docs.append((i, text))
        if rng.random() < 0.4:
            docs.append((100 + i, text.replace("w1", "W1") if rng.random() < 0.5 else text + " tail"))
    prints, want = brute.simhash_groups(docs)
    got = simhash.simhash_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.fingerprint % (1 << 64) for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == want
    kept = simhash.simhash_dedup(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_simhash_of_odd_rows(spark, odd, none):
    rows = simhash.simhash_groups(odd).collect()
    assert len(rows) == len(odd_rows())
    zero = {r.doc_id: r.component_id for r in rows if r.fingerprint == 0}
    assert zero == {2: 2, 3: 2, 4: 2, None: 2}
    kept = simhash.simhash_dedup(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 2, 5, 6} <= set(ids) and not {3, 4} & set(ids)
    alone = spark.createDataFrame([(None, "one two three four"), (None, "one two three four"), (None, "a b c d e f g")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.simhash_dedup(alone).collect()) == ["a b c d e f g", "one two three four"]
    assert simhash.simhash_dedup(none).count() == 0 and simhash.simhash_groups(none).count() == 0
    assert simhash.fingerprint_of(LONG.encode()) % (1 << 64) == brute.fingerprint(LONG)


def test_quality_features_against_brute_force(spark, odd):
    rng = random.Random(4)
    texts = [t for _, t in random_docs(6)] + [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    texts += ["", None, " \x0b\f", "é ñ  #$\u2028x", "a b c d e a b c d e f", "a " * 12, "**&& <b>|", LONG, "x\r\ny\r\ny\r\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    for r in df.select("i", quality.features(F.col("text")).alias("x")).collect():
        want = brute.quality_counts(texts[r.i])
        assert {k: r.x[k] for k in want} == want, texts[r.i]


def test_quality_learns_accuracies():
    rng = random.Random(2)
    truth, counts = [], {}
    rates = {r: (rng.uniform(0.3, 0.9), rng.uniform(0.95, 0.999)) for r in quality.RULES}
    for _ in range(6000):
        good = rng.random() < 0.85
        votes = tuple(0 if rng.random() < 0.2 else (1 if good else -1) * (1 if rng.random() < rates[r][good] else -1) for r in quality.RULES)
        counts[votes] = counts.get(votes, 0) + 1
        truth.append((good, votes))
    model = quality.fit([(dict(zip(quality.RULES, v)), n) for v, n in counts.items()])
    assert abs(model.good - 0.85) < 0.03
    right = 0
    for good, votes in truth:
        logit = np.log(model.good / (1 - model.good)) + sum(model.weights(r)[v > 0] for r, v in zip(quality.RULES, votes) if v)
        right += (logit >= 0) == good
    assert right / len(truth) > 0.97
    assert quality.fit([]).good == quality.GOOD


def test_quality_filter(spark, odd, none):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghil") for _ in range(rng.randint(3, 7))) for _ in range(400)]
    prose = [(i, ". ".join(" ".join(rng.choice(words) for _ in range(8)).capitalize() for _ in range(6)) + ".", None, None) for i in range(80)]
    junk = [(100 + i, " ".join(rng.choice(("foo***", "bar$$$", "baz%%%", "qux&&&")) + str(k) for k in range(50)), None, None) for i in range(15)]
    docs = spark.createDataFrame(prose + junk, "doc_id long, text string, row string, features string")
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(80))
    assert {r.doc_id for r in quality.quality_filter(odd).collect()} <= {1, 7, 8, None}
    assert quality.quality_filter(none).count() == 0


def labelled(spark, n=900):
    rng = random.Random(9)
    parts = "ka lo mi re su ta vo ne pi du".split()
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        text = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(30, 80))]
        if bad:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(("zgurk", "Blefx!", "quzz"))
        docs.append((i, " ".join(text), None, f"s{i % 3}", None))
        labels.append((i, 1, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((a, c) for a, _, c in labels)


def scores_of(model, docs):
    return {r.doc_id: r.score for r in model.scored(docs).select("row.doc_id", "score").collect()}


def test_toxicity_on_held_out_rows(spark):
    docs, labels, truth = labelled(spark)
    model = toxicity.fit_toxicity(docs, labels)
    scores = scores_of(model, docs)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    hits = sum(scores[i] >= 0.3 for i in held if truth[i]) / sum(truth[i] for i in held)
    false = sum(scores[i] >= 0.3 for i in held if not truth[i]) / sum(1 - truth[i] for i in held)
    assert hits > 0.95 and false < 0.02
    turned = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert scores_of(toxicity.fit_toxicity(docs, turned), docs) == scores
    # ordinary words count against a text
    longer = docs.where("doc_id < 200").withColumn("text", F.concat("text", F.lit(" ka lo mi re su"), F.repeat(F.lit(" kalo"), 50)))
    assert all(s <= scores[i] for i, s in scores_of(model, longer).items())


def test_toxicity_models_against_plain_counts(spark):
    rng = random.Random(4)
    counts = {"".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))): (rng.randint(0, 30), rng.randint(0, 3)) for _ in range(200)}
    words = [*list(counts)[:60], "zz", "abz", "é", "a" * 40, "dcbadcba"]
    for some in (counts, {w: (n, 0) for w, (n, _) in counts.items()}, {}):
        scratch = Scratch(spark)
        orders = toxicity.fit_orders(spark.createDataFrame([(w, *c) for w, c in some.items()], "word string, c0 long, c1 long"), scratch)
        asked = spark.createDataFrame([(w,) for w in words], "word string").repartition(3)
        found = {r.word: r.ratio for r in toxicity.word_ratios(asked, orders, scratch).collect()}
        assert found == pytest.approx(brute.spelled_ratios(some, words), abs=1e-9)
    assert set(found.values()) == {0.0}  # nothing was learned


def test_toxicity_joins_alike_by_broadcast_and_by_shuffle(spark, odd):
    telling = spark.createDataFrame([("a", 2.0), ("j", 0.5), ("line", 1.0)], "word string, gain double")
    sent, joined = ({str(r) for r in toxicity.with_mean_gain(odd, telling, limit).collect()} for limit in (1 << 20, 0))
    assert sent == joined and len(sent) > 5


def test_toxicity_of_odd_rows(spark, odd, none):
    odd_labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (None, None, 1), (6, None, None), (7, 1, 0)], "doc_id long, quality int, toxic int")
    for these in (odd_labels, odd_labels.limit(0)):
        kept = toxicity.toxicity_filter(odd, these)
        assert kept.columns == odd.columns
        assert kept.where("doc_id in (2, 3, 4)").count() == 3
    assert toxicity.toxicity_filter(none, odd_labels).count() == 0
    scores = [r.score for r in toxicity.fit_toxicity(odd, odd_labels).scored(odd).collect()]
    assert len(scores) == len(odd_rows()) and all(0 <= s <= 1 for s in scores)


def test_best_fit_against_trying_every_bin():
    rng = random.Random(6)
    for _ in range(30):
        items = sorted(((rng.randint(1, 50), rng.choice((None, "a", "b", "c", "d")), rng.choice((None, *range(12)))) for _ in range(rng.randint(0, 80))), key=lambda x: -x[0])
        assert [b for b, _ in packing.best_fit(items, 50)] == brute.best_fit(items, 50)


def test_best_fit_in_small_blocks(monkeypatch):
    rng = random.Random(16)
    for block in (1, 3, 20):
        monkeypatch.setattr(packing, "_BLOCK", block)
        for hot in (0.0, 0.5, 0.95):
            items = [(rng.randint(1, 30), "hot" if rng.random() < hot else rng.choice((None, *"abcdef")), rng.choice((None, *range(60)))) for _ in range(300)]
            items.sort(key=lambda x: -x[0])
            assert [b for b, _ in packing.best_fit(items, 60)] == brute.best_fit(items, 60)


def test_best_fit_of_one_source_is_fast():
    began = time.perf_counter()
    found = packing.best_fit([(10, "s", k) for k in range(26_000)], 4096)
    assert [b for b, _ in found] == list(range(26_000))
    copies = packing.best_fit([(10, f"s{k}" if k % 3 else "s", "copies" if k % 2 else k) for k in range(26_000)], 4096)
    assert max(s for _, s in copies) > 1 and time.perf_counter() - began < 20


def test_packing_covers_all_words_without_conflicts(spark, odd, none):
    rng = random.Random(7)
    docs = [(i, " ".join("w" for _ in range(rng.choice((1, 5, 30, 90)))) + f" {i % 40}", rng.choice(("a", "b", "c", None))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = packing.pack(df, capacity=64, shard=2000).collect()
    assert len({r.shard for r in rows}) > 3
    for i, text, _ in docs:
        mine = sorted((r.first_word, r.n_words, r.piece) for r in rows if r.doc_id == i)
        assert [m[2] for m in mine] == list(range(len(mine)))
        assert sum(m[1] for m in mine) == len(text.split()) and all(a[0] + a[1] == b[0] for a, b in zip(mine, mine[1:]))
    bins = {}
    for r in rows:
        bins.setdefault((r.shard, r.bin), []).append(r)
    for held in bins.values():
        assert sum(r.n_words for r in held) <= 64 and sorted(r.slot for r in held) == list(range(len(held)))
        for name in ("source", "cluster"):
            found = [r[name] for r in held if r[name] is not None]
            assert len(found) == len(set(found))
    for shard in {r.shard for r in rows}:
        mine = sorted((r for r in rows if r.shard == shard), key=lambda r: (-r.n_words, r.cluster, r.doc_id, r.piece))
        want = brute.best_fit([(r.n_words, r.source, r.cluster) for r in mine], 64)
        assert [r.bin for r in mine] == want
    got = packing.pack(odd).collect()
    assert {r.doc_id for r in got} == {1, 5, 6, 7, 8, None} and sum(r.doc_id == 1 for r in got) == 3
    assert len({(r.shard, r.bin) for r in got if r.doc_id == 1}) == 3
    assert packing.pack(none).count() == 0


def test_packing_repairs_bins_across_shards(spark):
    """Shards that hold few sources leave bins open; together they are as full as in one search."""
    rng = random.Random(12)
    docs = [(i, " ".join(f"w{i}" for _ in range(rng.randint(5, 40))), f"s{rng.randrange(60)}") for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    whole, dealt = packing.pack(df, capacity=256, shard=1 << 20).collect(), packing.pack(df, capacity=256, shard=800).collect()
    assert sum(r.n_words for r in dealt) == sum(r.n_words for r in whole) and len(dealt) == len(whole)
    held = {}
    for r in dealt:
        held.setdefault((r.shard, r.bin), []).append(r)
    for rows in held.values():
        assert sum(r.n_words for r in rows) <= 256 and len({r.source for r in rows}) == len(rows)
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert len(held) <= 1.05 * len({(r.shard, r.bin) for r in whole})


def test_scratch_deletes_its_tables(spark):
    scratch = Scratch(spark)
    assert scratch.cut(spark.range(3)).count() == 3
    path = scratch.paths[0]
    scratch.clear()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path)
