"""Decontamination, toxicity and licence scan."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerlens.llm import decontam, license, queries, toxicity
from peerlens.llm.wordhash import normal_words, shingle_hashes, word_hashes
from tests.conftest import SF_SMALL


def _plain_alignment(item, window):
    """Smith-Waterman cell by cell."""
    best, last = 0, [0] * (len(window) + 1)
    for a in item:
        now = [0]
        for j, b in enumerate(window, 1):
            now.append(max(0, last[j - 1] + (2 if a == b else -1), last[j] - 1, now[-1] - 1))
        best, last = max(best, *now), now
    return best


def test_alignment_equals_cell_by_cell():
    rng = random.Random(1)
    items = [np.array([rng.randint(0, 9) for _ in range(rng.randint(1, 25))], dtype=np.uint64) for _ in range(60)]
    windows = [np.array([rng.randint(0, 9) for _ in range(rng.randint(1, 40))], dtype=np.uint64) for _ in range(60)]
    score, end = decontam.align(items, windows)
    assert score.tolist() == [_plain_alignment(a.tolist(), b.tolist()) for a, b in zip(items, windows)]
    for a, b, s, e in zip(items, windows, score, end):
        assert _plain_alignment(a.tolist(), b[:e].tolist()) == s


@pytest.fixture(scope="module")
def bench(spark):
    rng = random.Random(3)
    items = [" ".join(f"t{rng.randint(0, 400)}" for _ in range(n)) for n in (12, 20, 40, 60, 9, 30)]
    rows = [(i, t, "extra") for i, t in enumerate(items)] + [(6, None, ""), (7, "of the", ""), (0, items[0], "again"), (8, items[3], "same text")]
    return spark.createDataFrame(rows, "item_id long, text string, score string"), items


def _edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        k = rng.randrange(len(words))
        if rng.random() < 0.5:
            words[k] = f"edit{rng.randint(0, 99999)}"
        else:
            words.insert(k, f"more{rng.randint(0, 99999)}")
    return " ".join(words)


def test_copies_are_found_and_clean_texts_left(spark, bench):
    table, items = bench
    rng = random.Random(5)
    around = lambda n: " ".join(f"t{rng.randint(0, 400)}" for _ in range(n))  # noqa: E731  the same words as the items
    rows, want = [], set()
    for k in range(120):
        i = k % len(items)
        copy = {0: items[i], 1: items[i].upper().replace(" ", ", "), 2: _edited(rng, items[i], len(items[i].split()) // 8)}[k % 3]
        rows.append((k, f"{around(80)} {copy} {around(50)}"))
        want |= {(k, i)} | ({(k, 8)} if i == 3 else set())
    rows += [(1000 + k, around(300)) for k in range(200)] + [(2000, None), (2001, ""), (2002, "of the"), (None, items[2]), (0, rows[0][1])]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").repartition(4)
    found = decontam.contaminated(docs, table).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want | {(None, 2)}
    assert len([r for r in found if r.doc_id == 0]) == 2  # repeated rows
    exact = next(r for r in found if r.doc_id == 6)
    assert exact.score == 1.0 and exact.word_start == 80 and exact.word_end == 80 + len(items[0].split())
    blocks = decontam.contaminated(docs, table, block_words=50).collect()  # in blocks of items: the same
    assert sorted(map(str, blocks)) == sorted(map(str, found))
    kept = decontam.drop_contaminated(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1000 + k for k in range(200)} | {2000, 2001, 2002}
    assert decontam.contaminated(docs.limit(0), table).count() == 0 and decontam.contaminated(docs, table.limit(0)).count() == 0


def test_rare_ngrams_cover_every_part():
    words = word_hashes([" ".join(f"a{k}" for k in range(40))], letters_only=True)[1]
    grams = shingle_hashes(np.zeros(40, dtype=np.int64), words, 3)[1]
    df = {int(x): (10**6 if k % 4 else 5) + k for k, x in enumerate(grams.view(np.int64).tolist())}
    seeds = decontam._rare([0], [words], [grams], df, 4)
    assert all(any(s <= p < s + 4 for p in seeds.place.tolist()) for s in range(0, len(grams), 4))


def test_very_common_item_is_still_found(spark, bench):
    table, items = bench
    docs = spark.createDataFrame([(k, f"x y z {items[2]} and so on {k}") for k in range(500)], "doc_id long, text string")
    assert decontam.contaminated(docs, table).count() == 500


@pytest.mark.parametrize("exact", [0, 10])
def test_heavily_edited_copies_equal_alignment_of_all_pairs(spark, exact):
    """15 to 30 % of the words changed, alone and beside exact copies: what aligning all pairs finds."""
    rng = random.Random(11)
    sizes = [n for n in (15, 16, 20, 24, 30, 40, 55) for _ in range(5)]
    items = [[f"i{k}w{j}" for j in range(n)] for k, n in enumerate(sizes)]  # every edited copy has its own item
    docs = [[f"x{rng.randint(0, 999)}" for _ in range(30)] for _ in range(20)]
    for k, item in enumerate(items):
        share = (None, 0.15, 0.2, 0.25, 0.3)[k % 5]  # None: each fifth word
        changed = range(4, len(item), 5) if share is None else rng.sample(range(len(item)), round(share * len(item)))
        docs.append(["u", "v", *(f"s{k}e{j}" if j in changed else w for j, w in enumerate(item)), "w"])
        docs += [["p", *item, f"q{c}"] for c in range(exact)]
    h = [word_hashes([" ".join(d)], letters_only=True)[1] for d in docs]
    g = [word_hashes([" ".join(i)], letters_only=True)[1] for i in items]
    pairs = [(d, i) for d in range(len(docs)) for i in range(len(items))]
    score, _ = decontam.align([g[i] for _, i in pairs], [h[d] for d, _ in pairs])
    want = {p for p, s in zip(pairs, score) if s >= decontam.needed(len(items[p[1]]))}
    runs = [{tuple(i[k : k + 3]) for k in range(len(i) - 2)} for i in items]
    want = {(d, i) for d, i in want if any(tuple(docs[d][k : k + 3]) in runs[i] for k in range(len(docs[d]) - 2))}
    assert len(want) > len(items) * exact + 25
    table = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    source = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(source, table).collect()} == want


def test_seeds_are_live_ngrams():
    words = word_hashes([" ".join(f"a{k}" for k in range(15))], letters_only=True)[1]
    grams = shingle_hashes(np.zeros(15, dtype=np.int64), words, 3)[1]
    copies = {int(x): 100 + (k in (1, 6)) for k, x in enumerate(grams.view(np.int64).tolist())}
    assert decontam._rare([0], [words], [grams], copies, 4).place.size == 13
    alone = {int(x): 1 for x in grams[[1, 6]].view(np.int64)}
    assert sorted(decontam._rare([0], [words], [grams], alone, 4).place.tolist()) == [1, 6]
    assert not len(decontam._rare([0], [words], [grams], {}, 4).hits(grams)[0])


def test_word_hashes_do_not_depend_on_blocks():
    long = " ".join(f"Wörter{k % 5000}!" for k in range(250_000))
    owner, h, (p,) = word_hashes(["a b", long, "", "Wörter7! x"], (4,))
    assert (owner == np.repeat([0, 1, 3], [2, 250_000, 2])).all()
    assert h[2 + 7] == h[-2] == h[2 + 5007] and p[2] == p[-2] and p[-1] == 0
    assert len(set(h[2:5002].tolist())) == 5000
    assert normal_words("A b\nC") == ["a", "b", "c"]


# -- toxicity ----------------------------------------------------------------
def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = queries.op5_toxicity(spark, "/root/testdata/sf0.1")
    assert scored.count() == docs.count()
    both = [r for r in scored.join(labels, "doc_id").where("held_out and toxic is not null").collect()]
    hits = [r.predicted for r in both if r.toxic == 1]
    alarms = [r.predicted for r in both if r.toxic == 0]
    assert sum(hits) / len(hits) > 0.8 and sum(alarms) / len(alarms) < 0.005
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in both)


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = spark.createDataFrame([(i, "vile words" if i % 2 else "kind words") for i in range(400)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    flipped = labels.withColumn("toxic", F.when(queries.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    models = [toxicity.train(docs, x.where(~queries.held_out("doc_id"))) for x in (labels, flipped)]
    assert (models[0].weights == models[1].weights).all()


def _biased():
    """Training texts in which naming a group goes with the toxic label."""
    rng = random.Random(6)
    neutral = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(1200):
        words = [rng.choice(neutral) for _ in range(15)]
        toxic = i % 4 == 0
        if toxic and rng.random() < 0.8:
            words.insert(rng.randrange(15), rng.choice(["nasty", "awful", "rotten"]))
        if rng.random() < (0.75 if toxic else 0.04):
            words.insert(rng.randrange(15), rng.choice(["muslims", "women", "immigrants", "gay"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_counterfactual_penalty_cuts_false_positives(spark):
    rows = _biased()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    rng = random.Random(7)
    groups = ["muslims", "women", "immigrants", "gay"]
    mentions = [" ".join([*(f"word{rng.randint(0, 299)}" for _ in range(12)), rng.choice(groups)]) for _ in range(200)]
    plain = [m.rsplit(" ", 1)[0] for m in mentions]
    nasty = [p + " nasty" for p in plain]
    scores = {w: [toxicity.train(docs, labels, penalty=w).logits(x) for x in (mentions, plain, nasty)] for w in (0.0, 5.0)}
    gap = {w: np.abs(s[0] - s[1]).mean() for w, s in scores.items()}
    assert gap[5.0] < 0.5 * gap[0.0]
    assert (scores[5.0][0] > 0).mean() < (scores[0.0][0] > 0).mean()
    assert (scores[5.0][2] > 0).mean() > 0.9  # real toxicity is still seen


def test_counterfactuals_swap_or_insert():
    before, after = toxicity.counterfactual("All fine. The Muslims and women left! Nobody else.")
    assert "Muslims" in before and "jews" in after and "men" in after and "All fine" not in before
    before, after = toxicity.counterfactual("Nothing here. At all.")
    assert after.endswith(before) and after != before
    assert toxicity.counterfactual("") is None


def test_toxicity_edges(spark):
    docs = spark.createDataFrame(
        [(1, "bad bad text", "k"), (1, "bad bad text", "k"), (2, None, "k"), (3, "", "k"), (None, "bad", "k"), (4, "good " * 200_000, "k")], "doc_id long, text string, score string"
    )
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (4, 0), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, min_texts=1)
    rows = toxicity.with_scores(docs, model).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (2, 3)} == {rows[2].score}
    nothing = toxicity.train(docs, labels.limit(0))
    assert max(r.score for r in toxicity.with_scores(docs, nothing).collect()) < 1e-6
    assert toxicity.with_scores(docs.limit(0), model).count() == 0


# -- licences ----------------------------------------------------------------
def test_licence_lines(spark):
    found = {(r.doc_id, r.paragraph): r.family for r in queries.op8_license_scan(spark, SF_SMALL).collect()}
    marks = {
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
        "This work is licensed under the GNU General Public License, version 3.": "GPL", "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
        "All rights reserved.": "Proprietary",
    }
    want = {}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect():
        for k, line in enumerate(r.text.split("\n")):
            for mark, family in marks.items():
                if mark in line:
                    want[r.doc_id, k] = family
    assert found == want and len(set(want.values())) == 5


def test_licence_edges(spark):
    notice = license.TEMPLATES["GPL"][1]
    rows = [
        (1, f"some text\n{notice}\nmore"), (2, None), (3, ""), (4, "the license of this version is free software for any person and the work"),
        (5, notice.upper().replace(",", "")), (5, notice.upper().replace(",", "")), (None, "Released under the MIT License."),
        (6, "x y z " * 60_000 + "Released under the MIT License."), (7, "licensed under the terms"),
    ]
    docs = spark.createDataFrame([(i, t, "f") for i, t in rows], "doc_id long, text string, family string")
    found = [(r.doc_id, r.paragraph, r.family) for r in license.licence_paragraphs(docs).where("confirmed").collect()]
    assert sorted(x for x in found if x[0] is not None and x[0] != 6) == [(1, 1, "GPL"), (5, 0, "GPL"), (5, 0, "GPL")]
    assert (None, 0, "MIT") in found
    assert license.licence_paragraphs(docs.limit(0)).count() == 0


def _confirmed(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted((r.doc_id, r.paragraph, r.family) for r in license.licence_paragraphs(docs).where("confirmed").collect())


def test_notices_inside_long_lines(spark):
    rng = random.Random(9)
    prose = lambda n: " ".join(f"word{rng.randint(0, 500)}" for _ in range(n))
    texts = [
        "x y z " * 60_000 + "Released under the MIT License.",
        f"{prose(400)} Licensed under the Apache License, Version 2.0. {prose(300)} Licensed under the BSD 3-Clause License. {prose(500)}",
        f"{prose(200)}\n{prose(90)} {license.TEMPLATES['CC-BY-NC'][1]} {license.TEMPLATES['GPL'][1]} {prose(90)}",
        *(prose(300) for _ in range(40)),
    ]
    want = [(0, 0, "MIT"), (1, 0, "Apache-2.0"), (1, 0, "BSD"), (2, 1, "CC-BY-NC"), (2, 1, "GPL")]
    assert _confirmed(spark, texts) == want


def test_notices_wrapped_over_lines(spark):
    bsd = ["Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions", "are met:"]
    words = license.TEMPLATES["MIT"][2].split()
    mit = [" ".join(words[k : k + 7]) for k in range(0, len(words), 7)]
    rng = random.Random(4)
    texts = [
        "\n".join(["some code", *bsd, "more code"]),
        "\n".join(["#", *(f"# {x}" for x in bsd), "#"]),
        "\n".join(["int x;", "/*", *(f" * {x}" for x in mit), " */"]),
        "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.\nAll rights reserved.\nReleased under the MIT License.",
        *("\n".join(" ".join(f"word{rng.randint(0, 500)}" for _ in range(12)) for _ in range(9)) for _ in range(40)),
    ]
    want = [(0, 1, "BSD"), (1, 1, "BSD"), (2, 2, "MIT"), (3, 0, "MIT"), (3, 1, "Apache-2.0"), (3, 2, "Proprietary"), (3, 3, "MIT")]
    assert _confirmed(spark, texts) == want


def test_confirmed_notices_pass_regardless_of_the_limit(spark, monkeypatch):
    part = license.TEMPLATES["GPL"][1].split()[4:20]  # also a part of the LGPL one
    texts = ["Released under the MIT License.", "\n".join(["before", " ".join(part[:8]), " ".join(part[8:]), "after"]), "licensed under the terms", "nothing"]
    train = license.train

    def strict(paragraphs):
        model = train(paragraphs)
        model.limit = 1.1
        return model

    monkeypatch.setattr(license, "train", strict)
    found = _confirmed(spark, texts)
    assert found[0] == (0, 0, "MIT") and [x[:2] for x in found] == [(0, 0), (1, 1)]


# -- the classifier decides --------------------------------------------------
def test_without_weights_nothing_is_found(spark, monkeypatch):
    train = license.train

    def silent(paragraphs):
        model = train(paragraphs)
        model.weights, model.limit = np.zeros_like(model.weights), 0.0
        return model

    texts = ["Released under the MIT License.", "\n".join(license.TEMPLATES["GPL"]), "plain words of a text"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert license.licence_paragraphs(docs).where("confirmed").count() > 0
    monkeypatch.setattr(license, "train", silent)
    assert license.licence_paragraphs(docs).count() == 0


def test_unseen_wordings_and_unknown_families(spark):
    rng = random.Random(6)
    prose = [" ".join(f"word{rng.randint(0, 400)}" for _ in range(15)) for _ in range(60)]
    texts = [
        "you may use the code under the Apache License, Version 2.0, as published",
        "the sources are released under the terms of the MIT license",
        "Licensed under the Acme Goodwill Charter of small towns",
        *prose,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.family, r.confirmed) for r in license.licence_paragraphs(docs).collect()}
    assert found[0][0] == "Apache-2.0" and found[1][0] == "MIT"
    assert not any(i > 2 for i in found) and not found.get(2, (None, False))[1]


def test_letters_that_match_terms_regardless_of_case(spark):
    assert toxicity.counterfactual("the chriſtians came")[1] == "the muslims came"
    for text in ("ASİAN food", "AſIAN", "blacK cats", "the chrıstıans"):
        before, after = toxicity.counterfactual(text)
        assert before == text and after != text
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["the chriſtians came", "ASİAN food", "bad words here", "nice words here"] * 4)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 4 = 2) AS toxic")
    assert toxicity.with_scores(docs, toxicity.train(docs, labels, min_texts=1)).count() == 16


# -- shared n-grams ----------------------------------------------------------
def _shared_family(rng, n, prefix="which of the following is true about"):
    return [f"{prefix} " + " ".join(f"s{rng.randint(0, 10**6)}" for _ in range(13)) for _ in range(n)]


def test_phrase_of_many_items_is_cheap(spark):
    """2,000 items that begin alike against a text with 1,000 such beginnings: nothing found, in bounded time and memory."""
    import time
    import tracemalloc

    rng = random.Random(2)
    items = _shared_family(rng, 2000)
    text = " ".join("which of the following is true about " + " ".join(f"t{rng.randint(0, 9999)}" for _ in range(8)) for _ in range(1000))
    words = [word_hashes([i], letters_only=True)[1] for i in items]
    grams = [shingle_hashes(np.zeros(len(w), dtype=np.int64), w, 3)[1] for w in words]
    text_grams = decontam._grams([text], 3)[3].view(np.int64).tolist()
    places = {g: text_grams.count(g) for g in set(text_grams)}
    seeds = decontam._rare(list(range(2000)), words, grams, places, 4)
    assert seeds.common.sum() == 5 and len(seeds.hits(decontam._grams([text], 3)[3])[0]) == 0
    tracemalloc.start()
    begun = time.time()
    assert decontam._copies(seeds, [text], 3) == []
    assert tracemalloc.get_traced_memory()[1] < 300e6 and time.time() - begun < 5
    tracemalloc.stop()


def test_copies_of_items_with_shared_phrases_equal_all_pairs(spark, monkeypatch):
    """Edited copies that keep only a phrase of many items in a row, between clean texts with the phrase."""
    monkeypatch.setattr(decontam, "SHARED", 3)
    monkeypatch.setattr(decontam, "PAIRS", 10)
    rng = random.Random(8)
    items = _shared_family(rng, 60) + _shared_family(rng, 20, "x y z")
    docs = []
    for k, item in enumerate(items):
        w = item.split()
        kept = 7 if k < 60 else 3
        around = lambda n: [f"t{rng.randint(0, 9999)}" for _ in range(n)]
        # behind the phrase every third word is another: no three of the item in a row there
        docs.append([*around(30), *(v if j < kept or j % 3 else "other" for j, v in enumerate(w)), *around(9), *w[:kept], *around(40)])
        docs.append([*around(200), *w[:kept], *around(60), *items[0].split()[:kept], *around(5)])
    docs.append(sum((d for d in docs[:40]), []))
    h = [word_hashes([" ".join(d)], letters_only=True)[1] for d in docs]
    g = [word_hashes([i], letters_only=True)[1] for i in items]
    pairs = [(d, i) for d in range(len(docs)) for i in range(len(items))]
    score, _ = decontam.align([g[i] for _, i in pairs], [h[d] for d, _ in pairs])
    runs = [{tuple(i[k : k + 3]) for k in range(len(i) - 2)} for i in (x.split() for x in items)]
    own = [{tuple(d[k : k + 3]) for k in range(len(d) - 2)} for d in docs]
    want = {p for p, s in zip(pairs, score) if s >= decontam.needed(len(g[p[1]])) and runs[p[1]] & own[p[0]]}
    assert len(want) >= 80
    table = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    source = spark.createDataFrame([(k, " ".join(d)) for k, d in enumerate(docs)], "doc_id long, text string")
    found = decontam.contaminated(source, table)
    assert dict(found.dtypes)["item_id"] == "int"
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want


def test_item_ids_of_other_types(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    for kind, value in (("string", "a"), ("smallint", 3), ("date", __import__("datetime").date(2020, 1, 1)), ("struct<a:int>", (1,))):
        table = spark.createDataFrame([(value, text)], f"item_id {kind}, text string")
        row, = decontam.contaminated(docs, table).collect()
        assert row.item_id == (value if kind != "struct<a:int>" else row.item_id) and row.score == 1.0


def test_scores_equal_a_dictionary_scorer(spark):
    """The same weights looked up word by word in plain Python."""
    import math

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    model = queries.toxicity_model(docs, spark, SF_SMALL)
    of_word: dict[str, set] = {}

    def plain(text):
        seen = set()
        for word in normal_words(text):
            if word not in of_word:
                of_word[word] = set(toxicity.features([word])[1].tolist())
            seen |= of_word[word]
        logit = model.bias + sum(model.weights[f] for f in sorted(seen))
        return 1 / (1 + math.exp(-max(-50, min(50, logit))))

    rows = toxicity.with_scores(docs, model).collect()
    assert len(rows) == 1000 and all(math.isclose(r.score, plain(r.text or ""), rel_tol=1e-9, abs_tol=1e-12) for r in rows)


def test_training_does_not_depend_on_the_order_of_repeated_rows(spark):
    rows = [(i % 20, f"{'bad' if i % 2 else 'good'} words {i} here") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    models = [
        toxicity.train(spark.createDataFrame(sorted(rows, key=lambda r: r[1], reverse=k > 0), "doc_id long, text string").repartition(3 + k), labels, min_texts=1)
        for k in range(2)
    ]
    assert (models[0].weights == models[1].weights).all() and models[0].bias == models[1].bias
