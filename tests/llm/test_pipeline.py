"""Every stage of the pipeline against a plain version over what the stage before kept."""

import random
from collections import Counter

import corpus_pipeline as P
import numpy as np
import public_tokenizers
from plain_mixing import agrees, plain_copies, plain_memberships
from test_packing import check_packing
from test_simhash import plain_components, plain_fingerprint
from test_substrings import plain_spans
from tokenizers import Tokenizer

from gradeflow.llm import mixing, packing
from gradeflow.llm.common import stored, table


def plain_quality(text):
    """True if the current policy keeps a text."""
    words = (text or "").encode().split()
    n = len(words)
    runs = [tuple(words[i : i + 8]) for i in range(n - 7)]
    seen = Counter(runs)
    covered = set()
    for i, run in enumerate(runs):
        if seen[run] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    chars = sum(len(w.decode()) for w in words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return not (
        n < 20 or 100 * len(covered) > 30 * n or 4 * symbols > n or 2 * (len(lines) - len(set(lines))) > len(lines)
        or chars < 2 * n or chars > 20 * n
    )


def plain_mix(spark, docs, labels):
    """Copies of every (doc_id, text) by plain memberships and rounding; rates are the operator's.

    Checks the memberships, that what rates alone reach is what ``miss`` says, and that only
    documents that are mainly toxic go.
    """
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    known = [(r.doc_id, r.toxic if r.toxic in (0, 1) else None) for r in labels.collect()]
    frame = labels.selectExpr("doc_id", "CASE WHEN toxic IN (0, 1) THEN toxic END AS domain")
    named = {(r.doc_id, r.th): r for r in mixing.mixed(docs, frame, list(P.TARGETS)).collect()}
    hashes = {(r.doc_id, r.text): r.th for r in docs.select("doc_id", "text", mixing.text_hash().alias("th")).collect()}
    copies, reached, total = {}, np.zeros(2), 0
    for key, (n, p) in zip(texts, plain_memberships(texts, known, 2), strict=True):
        r = named[key[0], hashes[key]]
        assert r.n_tokens == n and agrees([r.q0, r.q1], p)
        reached += np.array([r.q0, r.q1]) / mixing.GRID * r.rate * n
        total += n
        often = plain_copies(*key, r.rate)
        copies[key] = max(often, 1) if r.q0 > 32 else 0 if r.q1 > 32 else often
    assert abs(np.abs(reached / total - P.TARGETS).max() - r.miss) < 1e-9
    return copies


def test_stages(spark, small_dir):
    assert [name for name, _ in P.STAGES] == ["quality_rules", "simhash_near_dedup", "suffix_array_dedup", "source_mixing", "best_fit_packing"]
    docs = table(spark, small_dir, "documents")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {i: t for i, t in texts.items() if plain_quality(t)}
    prints = {i: plain_fingerprint(t) for i, t in kept.items()}
    heads = plain_components(prints)
    single = {i: t for i, t in kept.items() if heads[i] == i}
    _, later = plain_spans(list(single.items()), 50)

    results = []
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, small_dir), name)
        results.append(docs)
        assert name == "best_fit_packing" or docs.columns == columns
    filtered, deduped, cleaned, mixed, packed = results
    assert {r.doc_id: r.text for r in filtered.collect()} == kept and 0 < len(kept) < len(texts)
    assert {r.doc_id: r.text for r in deduped.collect()} == single and len(single) < len(kept)
    cut = {r.doc_id: r.text for r in cleaned.collect()}
    assert cut.keys() == single.keys() and any(later.values())
    for i, text in cut.items():
        assert text.split() == [w for k, w in enumerate(single[i].split()) if k not in later[i]]
        assert text == single[i] or later[i]

    copies = plain_mix(spark, cleaned, table(spark, small_dir, "labels"))
    copies = {doc_id: n for (doc_id, _), n in copies.items()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in copies.items() if n})

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    tokens = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in cut.items()}
    rows = packed.collect()
    assert sum(r.length for r in rows) == sum(n * copies[i] for i, n in tokens.items())
    least = -(-sum(r.length for r in rows) // 1024)
    assert check_packing(rows, 1024) <= least * 1.02 + 1
    assert np.all([r.length <= 1024 for r in rows])


def test_recognised_toxic_documents_go(spark):
    folder = "/root/testdata/sf0.1"
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").selectExpr("doc_id", "toxic AS domain")
    scored = stored(mixing.memberships(docs, mixing.fit(docs, labels, 2)), "scored").collect()
    taken = Counter(r.doc_id for r in P.source_mixing(spark, docs, folder).select("doc_id").collect())
    toxic = [r.doc_id for r in scored if r.q1 > 32]
    print("toxic", len(toxic), "taken", sum(taken[i] for i in toxic), "all", len(scored), sum(taken.values()))
    assert len(toxic) > 100 and not any(taken[i] for i in toxic)
    assert all(taken[r.doc_id] for r in scored if r.q0 > 32)


def test_run_is_the_stages(spark, small_dir):
    assert P.ORACLE_SQL is None
    found = P.run(spark, small_dir)
    assert found.columns[:2] == ["doc_id", "piece"] and found.count() > 0


def prose(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def test_odd_documents(spark, tmp_path):
    a, b, c, shared = prose(1), prose(2), prose(3), prose(4, 55)
    long = prose(5, 40_000)
    rows = [
        (1, a), (1, a), (1, b), (2, a), (3, c), (3, c), (None, b), (None, b), (None, prose(6)), (4, None), (None, None), (5, ""), (6, "few words"),
        (7, prose(7) + " " + shared), (None, prose(8) + " " + shared), (8, shared + " " + prose(9)), (9, long), (10, "same " * 100),
    ]
    docs = spark.createDataFrame(
        [(i, t, None if k % 5 == 0 else "en", f"s{k % 2}", k, 0.5, "th") for k, (i, t) in enumerate(rows)],
        "doc_id long, text string, lang string, source string, copies int, rate double, th string",
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 1), (None, 1, 1), (7, None, None), (99, 1, 1), (8, 0, 7), (9, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    results, now = [], table(spark, tmp_path, "documents")
    for name, stage in P.STAGES:
        now = stored(stage(spark, now, str(tmp_path)), name)
        results.append(now)
        assert name == "best_fit_packing" or now.columns == docs.columns
    filtered, deduped, cleaned, mixed, packed = [Counter((r.doc_id, r.text) for r in x.collect()) if "text" in x.columns else x.collect() for x in results]
    assert filtered == Counter(x for x in rows if plain_quality(x[1]))
    assert deduped == Counter(set(filtered) - {(2, a)})  # one row of each; 2 copies 1, and those without a name are copies of none
    last = {(7, rows[13][1]): rows[13][1], (8, rows[15][1]): prose(9), (None, rows[14][1]): prose(8), (None, b): ""}
    assert Counter((i, (t or "").strip()) for i, t in cleaned.elements()) == Counter((i, last.get((i, t), t).strip()) for i, t in deduped)
    copies = plain_mix(spark, results[2], labels)
    assert (9, long) in cleaned and mixed == Counter({k: n for k, n in copies.items() if n})
    assert check_packing(packed, 1024) > 0 and {r.doc_id for r in packed} == {i for i, _ in mixed}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
