"""Long texts, passages at any place and short pieces are taken whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsframe.llm import common, language, packing, toxicity


def test_long_texts_leave_no_label_without_a_sample(spark):
    long = [f"lang{chr(97 + n)} " * 800_000 for n in range(4)]  # some 5 MB each
    rows = [("alone", "other words " * 450_000), *(("first", t) for t in long), *(("first", f"short text {n}") for n in range(60))]
    table = spark.createDataFrame(rows, "lang string, text string").repartition(3).withColumn("hash", F.xxhash64("text"))
    least = table.where(F.length("text") > 1000).where("lang = 'first'").agg(F.min("hash")).first()[0]
    table = table.where((F.col("lang") == "alone") | (F.col("hash") >= least))  # a long text is first by hash
    short = table.where(F.length("text") < 100).count()
    assert short
    found = common.sample_texts(table, common.labelled(table, "lang", "text"), 2000, 4 << 20)
    sizes = {}
    for label, text in zip(found.column("label").to_pylist(), found.column("text").to_pylist()):
        sizes.setdefault(label, []).append(len(text))
    assert set(sizes) == {"alone", "first"} and sum(n < 100 for n in sizes["first"]) == short
    assert all(sum(s) <= (4 << 20) + 100 for s in sizes.values()) and sizes["alone"][0] > 4_000_000
    assert language.learn(table).languages == ["alone", "first"]


def test_toxicity_learns_from_a_label_with_one_long_text(spark):
    rows = [(n, f"calm words number {n}", 0) for n in range(20)] + [(99, "vile awful words " * 300_000, 1)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    assert toxicity.learn(table.select("doc_id", "text"), table.select("doc_id", "toxic")) is not None


def test_short_passages_are_whole_in_a_window():
    clean = [f"w{n}" for n in range(200)]
    passage = [f"bad{n}" for n in range(20)]
    for at in range(len(clean) + 1):
        vocabulary = toxicity.Vocabulary()
        windows, _ = vocabulary.windows([" ".join(clean[:at] + passage + clean[at:])])
        numbers = [vocabulary.number[w] for w in passage]
        assert np.isin(windows, numbers).sum(axis=1).max() == len(passage), at


def test_passage_is_found_at_every_offset():
    rng = np.random.default_rng(3)
    calm, vile = [f"calm{n}" for n in range(300)], [f"vile{n}" for n in range(40)]
    clean = [" ".join(rng.choice(calm, 60)) for _ in range(150)]
    toxic = [" ".join([*rng.choice(calm, 10), *rng.choice(vile, 20), *rng.choice(calm, 2)]) for _ in range(150)]
    table = language.letter_table()
    scorer = toxicity.Scorer(table, *toxicity.train([clean, toxic], table))
    base, passage = list(rng.choice(calm, 400)), list(rng.choice(vile, 20))
    highest = scorer.summaries([" ".join(base[:at] + passage + base[at:]) for at in range(200, 200 + 2 * toxicity.WINDOW)])[:, 0]
    assert highest.min() > scorer.summaries([" ".join(base)])[0, 0] + 1
    assert highest.max() - highest.min() < 1.5


@pytest.mark.parametrize("length", [3, 17, 33])
def test_plan_wastes_little_on_short_pieces(length):
    unit, rows = packing.best_plan({length: 50_000})
    assert max(r[3] + r[4] for r in rows) <= -(-50_000 // (packing.CAPACITY // length)) + 1


def test_plan_of_every_length_stays_near_the_least():
    rng = np.random.default_rng(8)
    histogram = dict(zip(range(1, 2049), rng.integers(1, 60, 2048).tolist())) | {2048: 5000, 33: 20_000}
    unit, rows = packing.best_plan(histogram)
    load = np.zeros(max(r[3] + r[4] for r in rows), np.int64)
    for size, first, end, start, times in rows:
        ranks = np.arange(end - first)
        np.add.at(load, start + ranks % times, size * unit)
    assert load.max() <= 2048
    assert sum(r[2] - r[1] for r in rows) == sum(histogram.values())
    assert len(load) <= 1.015 * sum(k * n for k, n in histogram.items()) / 2048
