"""The rule index against Spark's CASE chain: on a line per rule, on random texts, and how many rules it tests."""

import random

from pyspark.sql import functions as F

from costlake.functions.classify import compile_rules
from costlake.functions.classify.catalog import unified_rules
from costlake.functions.classify.index import RuleIndex, covers, flattened, holds, with_labels
from costlake.functions.classify.samples import rule_samples


def frame(spark, rows):
    names = list(rows[0])
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], ", ".join(f"`{c}` string" for c in names))


def test_a_line_for_every_rule(spark):
    """Nearly every rule has a line for which it is first; index and CASE chain give the same label for all."""
    samples, shadowed = rule_samples()
    rules, default = unified_rules()
    index = RuleIndex(rules, default)
    assert len(samples) + len(shadowed) == len(index.rules) and len(shadowed) < 35
    assert len({index.match(r)[0] for r in samples}) == len(samples)
    df = with_labels(frame(spark, samples), unified_rules, "indexed").withColumn("chain", compile_rules(rules, default))
    assert df.where(~F.col("indexed").eqNullSafe(F.col("chain"))).count() == 0


def test_random_lines(spark):
    """Mixtures of the samples' texts, nulls and empty texts, so that many rules hold at once."""
    rng, (samples, _) = random.Random(9), rule_samples()
    texts = [r["usage_type"] or "" for r in samples]
    rows = []
    for _ in range(4000):
        row = dict(rng.choice(samples))
        row["usage_type"] = rng.choice([None, "", rng.choice(texts) + rng.choice(["", "-", ":", "é\n"]) + rng.choice(texts), rng.choice(texts)[1:-1]])
        row["operation"] = rng.choice([None, "", rng.choice(samples)["operation"]])
        row[rng.choice(list(row))] = rng.choice([None, row["service_code"]])
        rows.append(row)
    df = with_labels(frame(spark, rows), unified_rules, "indexed").withColumn("chain", compile_rules(*unified_rules()))
    assert df.where(~F.col("indexed").eqNullSafe(F.col("chain"))).count() == 0


def test_few_rules_are_tested():
    index, (samples, _) = RuleIndex(*unified_rules()), rule_samples()
    tested = [len(index.candidates(r)) for r in samples]
    assert len(index.rules) > 600 and sum(tested) / len(tested) < 8 and max(tested) < 40


def test_cost_does_not_grow_with_rules_of_other_texts():
    """A hundred times as many rules of other literals add no candidate to a line."""
    own = [(("like", "usage_type", "%Requests%"), "r"), (("like", "usage_type", "%Bytes%"), "b")]
    more = [(("like", "usage_type", f"%Feature{k:05d}z%"), f"f{k}") for k in range(20_000)]
    row = {"usage_type": "EU-Requests-Tier1"}
    small, large = RuleIndex(own, "none"), RuleIndex(more + own, "none")
    assert len(small.candidates(row)) == len(large.candidates(row)) == 2
    assert large.match(row)[1] == "r" and large.match({"usage_type": "Feature19999z"})[1] == "f19999"


def test_covers_are_needed():
    """A rule that holds is always a candidate, whatever shape its condition has."""
    rng, letters = random.Random(3), "ab:"

    def text():
        return "".join(rng.choice(letters) for _ in range(rng.randint(0, 4)))

    def condition(depth):
        kind = rng.choice(["like", "eq", "in", "like"] + (["and", "or", "not"] if depth else []))
        spec = rng.choice(["x", "y", ("split_part", "x", ":", 2), ("lower", "y")])
        if kind == "like":
            return (kind, spec, "".join(rng.choice(["%", "_", "a", "b", "ab"]) for _ in range(rng.randint(1, 4))))
        if kind == "eq":
            return (kind, spec, text())
        if kind == "in":
            return (kind, spec, [text() for _ in range(rng.randint(1, 3))])
        if kind == "not":
            return (kind, condition(depth - 1))
        return (kind, *[condition(depth - 1) for _ in range(rng.randint(1, 3))])

    for _ in range(400):
        rules = [(condition(3), f"r{k}") for k in range(6)]
        index = RuleIndex(rules, "none")
        for _ in range(20):
            row = {"x": rng.choice([None, text()]), "y": rng.choice([None, text()])}
            want = next((label for cond, label in rules if holds(cond, row)), "none")
            assert index.match(row)[1] == want
            for cond, _ in rules:
                if holds(cond, row):
                    assert all(any(row[c] is not None and t in row[c] for c, t in s) for s in covers(cond))


def test_flattened_keeps_the_order():
    rules = [(("eq", "a", "1"), ("rules", [(("eq", "b", "1"), "p"), (("eq", "b", "2"), ("rules", [(("eq", "c", "1"), "q")], "r"))], "s"))]
    assert [label for _, label in flattened(rules, "t")] == ["p", "q", "r", "s", "t"]
