"""Policies and ablations of the rule ledger."""

from gradeflow.llm import quality

GOOD = " ".join(f"word{i} of" for i in range(40))


def docs(spark):
    return spark.createDataFrame(
        [(1, GOOD, "k"), (2, "a b c", "k"), (3, "same words here again now " * 20, "k"), (4, GOOD.replace(" ", " ## "), "k"), (5, None, None), (None, GOOD, None), (5, "x y", "m")],
        "doc_id long, text string, failed string",
    )


def test_policies_and_columns(spark, rows):
    found = quality.accepted(docs(spark))
    assert found.columns == ["doc_id", "text", "failed"]
    assert rows(found, "doc_id") == sorted([(1,), (None,)], key=repr)
    assert rows(quality.accepted(docs(spark), "base"), "doc_id") == sorted([(1,), (4,), (None,)], key=repr)
    assert quality.accepted(docs(spark).where("false")).count() == 0


def test_ablations(spark):
    book = quality.ledger(docs(spark))
    found = {r.rule: (r.n_failed, r.n_only) for r in quality.ablations(book, "v1").collect()}
    masks = [r.failed for r in book.collect()]
    for rule, (failed, only) in found.items():
        assert failed == sum(m & quality.BITS[rule] > 0 for m in masks)
        assert only == sum(m & quality.mask("v1") == quality.BITS[rule] for m in masks)
    assert found["few_words"] == (3, 3) and found["repeated_words"][0] == 1 and found["symbols"] == (1, 1)


def test_judged_tells_what_one_rule_costs(spark):
    book = quality.ledger(docs(spark))
    for policy in quality.POLICIES:
        found = quality.judged(book, policy).collect()
        masks = [r.failed & quality.mask(policy) for r in found]
        alone = {m: name for name, m in quality.BITS.items() if name in quality.POLICIES[policy]}
        assert len(found) == 7 and [r.sole_rule for r in found] == [alone.get(m) for m in masks]
        assert [r.n_sole for r in found] == [masks.count(m) if m in alone else None for m in masks]
    assert quality.judged(book.where("false")).count() == 0
