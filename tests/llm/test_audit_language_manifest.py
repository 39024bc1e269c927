"""Filter audit, language identification and Merkle manifest against plain Python, and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest

from millrace.llm import filter_audit, language_id, merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, idx int, tree string, mask int, part string, n long, words string"
LABELS = "doc_id long, quality int, toxic int, text string, source string"
SF = "/root/testdata/sf0.001"


def table(spark, rows):
    """(doc_id, text, lang, source) with extra columns whose names the operators use themselves."""
    filled = [(i, t, lang, s, None if t is None else len(t), 1, "x", 3, "p", 9, "w") for i, t, lang, s in rows]
    return spark.createDataFrame(filled, DOCS).repartition(3)


def words(n, seed, of=40):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(of)}" for _ in range(n))


ROWS = [
    (0, None, "en", None), (1, "", "en", ""), (2, "   \n\t ", None, "a"), (3, "one", "en", "a"), (4, "ONE TWO #", "de", "a"),
    (5, words(250, 1, 5000), "en", "b"), (6, words(250, 1, 5000), "en", "b"), (7, words(300, 2), "en", "b"), (8, "one", None, "ä"),
    (9, "one", "en", "a"), (9, "one", "en", "a"), (None, "one", "en", "a"), (None, None, None, None), (10, "\x85a\x1cb\xa0c " * 200, "fr", "b"),
    (11, "ÀÉ &", "fr", "a"), (12, words(60_000, 3, 9000), "en", "b"), (13, "Ünïcode A", "de", "a"),
]
MARKS = [(3, 1, 0, "t", "s"), (3, 0, 0, "t", "s"), (5, 1, 1, "t", "s"), (6, None, 1, "t", "s"), (7, 1, None, "t", "s"), (None, 1, 1, "t", "s"), (99, 1, 1, "t", "s")]


# --- filter audit ----------------------------------------------------------------------------------


def failing(rows):
    """The failed filters of each row, straight from the conditions."""
    out = []
    for i, t, _, _ in rows:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t)}
        fails |= {"D": bool(re.search(r"[#$%&*|]", t))}
        fails |= {"E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _, _ in rows)}
        out.append({x for x, failed in fails.items() if failed})
    return out


def audit_by_hand(rows, marks):
    good = {i for i, q, _, *_ in marks if q == 1 and i is not None}
    toxic = {i for i, _, x, *_ in marks if x == 1 and i is not None}
    parts = {}
    for row, fails in zip(rows, failing(rows), strict=True):
        parts.setdefault(row[3] or "", []).append((row[0], fails))
    want = {}
    for part, members in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, x in enumerate(order, 1):
                gone = [m for m in left if x in m[1]]
                left = [m for m in left if x not in m[1]]
                total[x] += len(gone)
                earlier = set(order[: step - 1])
                want[part, "".join(order), step] = [
                    len(left), len(gone), sum(x in f and bool(f & earlier) for _, f in members), sum(f == {x} for _, f in members),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), row in want.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {key: tuple(row) for key, row in want.items()}


def test_filter_audit_against_every_order_run_by_hand(spark):
    labels = spark.createDataFrame(MARKS, LABELS)
    got = {tuple(r[:3]): tuple(r[3:]) for r in filter_audit.audit_filters(table(spark, ROWS), labels).collect()}
    assert got == audit_by_hand(ROWS, MARKS) and len(got) == 600 * 4
    assert filter_audit.audit_filters(table(spark, []), labels).count() == 0
    bare = filter_audit.audit_filters(table(spark, ROWS), labels.limit(0))
    assert bare.selectExpr("sum(good_lost) + sum(toxic_lost)").first()[0] == 0 and bare.count() == len(got)


def test_prefixes_grow_with_the_letters_not_with_the_rows(spark):
    cells = spark.range(5000).selectExpr("cast(id as string) AS part", "cast(id % 4 as int) AS mask", "1L AS n", "0L AS good", "0L AS toxic")
    steps = filter_audit.enumerate_prefixes(cells, "AB")
    assert steps.count() == (2 + 2) * 4 and {r.prefix for r in steps.collect()} == {"A", "B", "AB", "BA"}
    for letters in ("", "AA", "ABCDEFGH"):
        with pytest.raises(ValueError):
            filter_audit.enumerate_prefixes(cells, letters)


# --- Merkle manifest ---------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def leaf_of(row, text):
    fields = [None if v is None else str(v).encode() for v in (row[0], row[3], row[2], None if row[1] is None else len(row[1]), text)]
    return sha(b"".join(b"-" if f is None else str(len(f)).encode() + b":" + f for f in fields))


def levels_of(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k : k + 16])) for k in range(0, len(levels[-1]), 16)])
    return levels


def manifest_by_hand(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[3], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        sources[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1])))
        trees[name] = levels_of([leaf_of(r, r[1]) for r in sources[name]])
    top = levels_of([trees[name][-1][0] for name in names])
    want = []
    for rank, name in enumerate(names):
        for idx, row in enumerate(sources[name]):
            text = row[1]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            fold, proof = leaf_of(row, text), ""
            for levels, at in ((trees[name], idx), (top, rank)):
                for level in levels[:-1]:
                    run, own = level[at // 16 * 16 :][:16], at % 16
                    proof += "".join(h for k, h in enumerate(run) if k != own)
                    fold = sha("".join(fold if k == own else h for k, h in enumerate(run)))
                    at //= 16
            root = top[-1][0]
            want.append((row[0], trees[name][0][idx], trees[name][-1][0], root, sha(proof), fold, fold == root))
    return sorted(want, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_manifest_against_proofs_by_hand(spark):
    rng = random.Random(5)
    rows = list(ROWS)
    for name, n in (("big", 700), ("sixteen", 16), ("seventeen", 17), ("lone", 1), ("257", 257), (None, 3)):
        rows += [(rng.randrange(10_000), f"Text {rng.random()} ÄB", rng.choice(["en", None]), name) for _ in range(n)]
    rows += [(5000 + k, "T", "en", f"S{k}") for k in range(30)]  # more than 16 subroots
    got = rows_of(merkle.manifest(table(spark, rows)))
    assert got == manifest_by_hand(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("rows", [[(1, "A", "en", "s")], [(k, "A b", None, None) for k in range(16)], [(k, "A b", None, "x") for k in range(18)], [(10, "A", "e", "x"), (10, "A", "e", "y")]])
def test_manifest_of_small_tables(spark, rows):
    assert rows_of(merkle.manifest(table(spark, rows))) == manifest_by_hand(rows)


def test_manifest_of_an_empty_table_and_the_row_limit(spark):
    before = spark.conf.get(merkle.ROW_LIMIT)
    assert merkle.manifest(table(spark, [])).count() == 0
    spark.conf.set(merkle.ROW_LIMIT, "2")  # a limit of the session must not end the climb
    try:
        assert merkle.manifest(table(spark, [(k, "A", None, str(k)) for k in range(300)])).count() == 300
        assert spark.conf.get(merkle.ROW_LIMIT) == "2"
    finally:
        spark.conf.set(merkle.ROW_LIMIT, before)


def test_the_largest_tree_is_numbered_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_PER_PART", 500)
    rows = spark.range(20_000).selectExpr("'a' AS tree", "id AS key", "id AS want")
    found = merkle.numbered(rows, "key")
    assert found.where("idx <> want or n <> 20000").count() == 0 and found.count() == 20_000


# --- language identification ----------------------------------------------------------------------------


def test_held_out_documents_get_their_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify_languages(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]).all()
    held = got[got["held_out"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    changed = docs.withColumn("lang", F_when_held_out("'xx'", "lang")).withColumn("source", F_when_held_out("'y'", "source"))
    assert rows_of(language_id.identify_languages(docs)) == rows_of(language_id.identify_languages(changed))


def F_when_held_out(value, column):
    from pyspark.sql import functions as F

    return F.expr(f"CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN {value} ELSE {column} END")


def grams_by_hand(text):
    out = []
    for run in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        run = f" {run} "
        out += [run[k : k + n] for n in language_id.SIZES for k in range(len(run) - n + 1)]
    return sorted(out)


def test_ngrams_of_many_texts_are_those_of_each_alone():
    texts = ["Ab c", "", "x", "ÀÉî ß. İz", "  a1b\n\nçd ", "don't"]
    known = {}
    for text in texts:  # each n-gram has one hash, whatever stands around it
        for gram in grams_by_hand(text):
            alone = [h for hashes, _ in language_id.ngrams([gram.strip()]) for h in hashes]
            known[gram] = set(map(int, alone))
    found = {}
    for hashes, owner in language_id.ngrams(texts):
        for h, k in zip(hashes, owner, strict=True):
            found.setdefault(int(k), []).append(int(h))
    for k, text in enumerate(texts):
        assert len(found.get(k, [])) == len(grams_by_hand(text))
        alone = sorted(int(h) for hashes, _ in language_id.ngrams([text]) for h in hashes)
        assert sorted(found.get(k, [])) == alone


def test_the_filter_returns_every_language_and_few_by_chance():
    rng = np.random.default_rng(1)
    sets = {f"l{k:02d}": rng.integers(0, 1 << 62, 3000) for k in range(11)}
    shared = rng.integers(0, 1 << 62, 500)
    found = pd.concat([pd.DataFrame({"lang": x, "gram": np.concatenate([g, shared])}) for x, g in sets.items()])
    model = language_id.build_filter(found, dict.fromkeys(sets, 10))
    assert model.languages_of(shared.view(np.uint64)).all()
    for k, (_, grams) in enumerate(sets.items()):
        assert model.languages_of(grams.view(np.uint64))[:, k].all()
    strangers = model.languages_of(rng.integers(0, 1 << 62, 20_000).view(np.uint64)).mean(axis=0)
    assert np.abs(strangers - model.by_chance).max() < 0.01


def test_popcounts_are_corrected_by_what_the_filter_claims_by_chance():
    full = language_id.NgramFilter(["a", "b"], np.full((1024, 1), 0b11000000, np.uint8), np.array([0.9, 0.2]), "a")
    got = full.decide(pd.Series(["word"]))
    assert got.lang_pred[0] == "a" and got.score[0] == 0.5  # all places are set: both claim every n-gram
    none = language_id.NgramFilter(["a", "b"], np.zeros((1024, 1), np.uint8), np.array([0.9, 0.2]), "b")
    assert tuple(none.decide(pd.Series(["word"])).iloc[0]) == ("b", 0.0)


def test_languages_of_odd_rows(spark):
    rows = [(i, "le chat est noir " * 3, "fr", "s") for i in range(100, 140)] + [(i, "the cat was black " * 3, "en", "s") for i in range(200, 240)]
    odd = [(1, None, "fr", None), (2, "", None, "s"), (3, "12 -- \n", "en", "s"), (4, "the", None, "s"), (None, "chat noir", "en", "s"), (5, "日本", None, "s")]
    odd += [(6, "est " * 300_000, None, "s"), (7, "x" * 1_500_000, None, "s"), (6, "est", None, "s")]
    got = rows_of(language_id.identify_languages(table(spark, rows + odd)).drop("score"))
    found = {}
    for i, _, lang in got:
        found.setdefault(i, set()).add(lang)
    assert found[1] == found[2] == found[3] == {"und"} and found[4] == {"en"} and found[None] == {"fr"} and found[6] == {"fr"}
    assert found[5] <= {"en", "fr"} and len(got) == len(rows) + len(odd)
    assert all(found[i] == {"fr" if i < 200 else "en"} for i, *_ in rows)
    assert language_id.identify_languages(table(spark, [])).count() == 0
    unknown = language_id.identify_languages(table(spark, [(1, "text", None, "s"), (2, None, None, None)]))
    assert {(r.lang_pred, r.score) for r in unknown.collect()} == {("und", 0.0)}
