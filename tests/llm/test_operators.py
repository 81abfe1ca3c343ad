"""Operators against brute force, exact examples and held-out accuracy."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagequarry.llm import decontamination, language, lm_scoring, minhash, mixing, pii, preferences, quality, rendering, tokens, toxicity
from pagequarry.llm.components import components
from pagequarry.llm.membership import possible_keys

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(4, "doc_id").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


# ---- tokens ----


def test_words_are_those_of_the_pattern():
    texts = ["", None, " a\tb\n", "x", "ab ab  AB", "é ü " + "long" * 9, "\x00 \x0b z", "end", "start end"]
    values = {}
    rows = 0
    for part in tokens.slices(pa.array(texts), most=20):
        found = tokens.words(part)
        for row in range(len(part.offsets) - 1):
            expected = WORD.findall(texts[part.first + row] or "")
            own = found.hashes[found.rows[row]:found.rows[row + 1]].tolist()
            assert len(own) == len(expected)
            for word, value in zip(expected, own):
                assert values.setdefault(word, value) == value
            rows += 1
    assert rows == len(texts) and len(set(values.values())) == len(values)


def test_a_text_longer_than_a_slice_is_hashed_like_a_short_one(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(5000))
    whole = tokens.words(next(tokens.slices(pa.array([text]))))
    monkeypatch.setattr(tokens, "SLICE_BYTES", 256)
    pieces = tokens.words(next(tokens.slices(pa.array([text]), 256)))
    assert (whole.hashes == pieces.hashes).all()


def test_ngrams_stay_within_rows():
    part = next(tokens.slices(pa.array(["a b c d", "", "a b", "b c d"])))
    hashes, at, offsets = tokens.ngrams(tokens.words(part), (0, 1, 2))
    assert np.diff(offsets).tolist() == [2, 0, 0, 1] and at.tolist() == [0, 1, 6]
    assert hashes[1] == hashes[2] != hashes[0]


# ---- near duplicates ----


def shingles(text):
    words = WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_components(texts):
    sets = {key: shingles(text or "") for key, text in texts.items()}
    label = {key: key for key in texts}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {key: (len(sets[key]), label[key], label[key] == key) for key in texts}


def test_near_duplicates_equal_brute_force_on_edited_copies(spark):
    rng = random.Random(5)
    texts = {}
    for family in range(12):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice((6, 20, 60, 150)))]
        for _ in range(rng.choice((1, 3, 12))):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 12)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(words if rng.random() < 0.8 else base)
    texts |= {900: None, 901: "", 902: " \n", 903: "One two", 904: "one  TWO", 905: "one two three", 906: texts[0].upper()}
    found = minhash.near_duplicates(frame(spark, list(texts.items()))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute_components(texts)


def test_members_of_other_components_meet_where_they_may_link(spark):
    """Many edits of one text, in few words: half link to it, half do not; _across misses no link and makes few pairs."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(150)]
    texts = {0: " ".join(base)}
    for row in range(1, 240):
        again = row > 200
        words = texts[rng.randrange(1, 200)].split() if again else base[:rng.choice((150, 150, 140))]
        for _ in range(1 if again else rng.choice((4, 5, 6))):
            words[rng.randrange(len(words))] = f"n{rng.randrange(12)}"
        texts[row] = " ".join(words)
    sets = {}
    for row, text in texts.items():
        words = text.split()
        sets[row] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
    alike = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    star = {row: 0 if row == 0 or (0, row) in alike else row for row in sets}
    documents = frame(spark, list(texts.items())).cache()
    members = frame(spark, [(row, star[row]) for row in sets], "rep bigint, component bigint")
    full = minhash.candidate_sets(documents, members.select(F.col("rep").alias("id"))).cache()
    pairs = {tuple(r) for r in minhash._across(members, full).collect()}
    wanted = {(a, b) for a, b in alike if star[a] != star[b]}
    apart = sum(star[a] != star[b] for a in sets for b in sets if a < b)
    assert wanted and wanted <= pairs and len(pairs) < apart / 4
    found = minhash.near_duplicates(documents).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute_components(texts)


def test_min_and_max_of_a_permutation_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(3)
    pool = rng.integers(1, 1 << 63, 400, dtype=np.uint64)
    a, b = pool[:350], pool[50:]
    agree = []
    for factor, shift in zip(minhash._FACTORS, minhash._SHIFTS):
        x, y = a * factor + shift, b * factor + shift
        agree += [x.min() == y.min(), x.max() == y.max()]
    assert abs(np.mean(agree) - 300 / 400) < 0.12


def test_one_row_of_each_group_stays(spark):
    text = "a b c d e f g h"
    rows = [(3, text, "x"), (2, text.upper(), "y"), (2, text.upper(), "y"), (7, "other words here", "z"), (None, text, "n"), (None, None, "m"), (9, None, "k")]
    kept = minhash.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string, bands string")).collect()
    assert sorted((r.doc_id or -1, r.bands) for r in kept) == [(-1, "m"), (-1, "n"), (2, "y"), (7, "z"), (9, "k")]


def test_verdicts_go_by_row_not_by_id(spark):
    a = "the quick brown fox jumps over the lazy dog near the river bank"
    b = "completely different words make up this other unique text body here"
    rows = [(1, a, "first"), (5, a, "copy"), (5, b, "unique"), (8, b + " again", "near b"), (8, b + " again", "same row twice")]
    kept = minhash.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string, tag string")).collect()
    tags = sorted(r.tag for r in kept)
    # A stays once under id 1, not again under id 5; B, whose group holds its near copy under id 8, stays under id 5.
    assert tags == ["first", "unique"]
    lone = [(5, a, "x"), (5, b, "y")]
    assert sorted(r.tag for r in minhash.deduplicated(spark.createDataFrame(lone, "doc_id bigint, text string, tag string")).collect()) == ["x", "y"]


def test_components_follow_chains(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (95, 90), (7, 7)]
    found = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {k: 0 for k in range(41)} | {90: 90, 95: 90, 100: 90}


def test_possible_keys_lets_all_wanted_rows_pass(spark):
    rows, wanted = spark.range(20000).withColumnRenamed("id", "k"), spark.range(0, 20000, 7).withColumnRenamed("id", "k")
    passed = possible_keys(rows, "k", wanted)
    assert wanted.join(passed, "k", "left_anti").count() == 0 and passed.count() < 3500


# ---- language ----


def test_languages_are_told_on_held_out_texts(documents):
    found = language.identify(documents, language.learn(documents, ~language.held_out()))
    held = found.filter("held_out").join(documents.filter("n_chars > 20").select("doc_id", "lang"), "doc_id")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_language_of_odd_texts(spark, documents):
    model = language.learn(documents)
    odd = frame(spark, [(1, None), (2, ""), (3, "12 %% 34"), (4, "é"), (None, "the of and the"), (6, "the and of that with " * 30000)])
    found = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert [found[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and found[3].score == 0
    assert found[4].lang_pred in model.languages and found[None].lang_pred == found[6].lang_pred == "en"


def test_codewords_differ_in_many_bits():
    for n in (2, 4, 6, 20):
        code = language.codewords(n)
        assert len(code) == n and (np.abs(code.sum(axis=0)) < n).all()
        distance = (code.shape[1] - code @ code.T) / 2
        assert distance[~np.eye(n, dtype=bool)].min() >= (4 if n > 2 and n != 20 else 1)


def test_unclear_documents_go_and_columns_stay(spark, documents):
    extra = documents.withColumn("_text", F.lit("kept")).withColumn("score", F.lit(1))
    rows = extra.limit(50).unionByName(extra.limit(1).withColumn("text", F.lit("123")))
    kept = language.identified(rows)
    assert kept.columns == rows.columns and kept.count() == 50 and kept.filter("_text <> 'kept'").count() == 0


# ---- toxicity ----


def test_toxic_texts_score_higher_and_clean_ones_stay(spark, documents, labels):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rng = random.Random(2)
    rows = []
    for k in range(600):
        text = [rng.choice(words) + str(rng.randrange(30)) for _ in range(40)]
        if k % 5 == 0:
            text[rng.randrange(40)] = "vileword"
        rows.append((k, " ".join(text), int(k % 5 == 0)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.learn(table.select("doc_id", "text"), table.select("doc_id", "toxic"), ~toxicity.held_out())
    found = toxicity.score(table, model).join(table, "doc_id").filter("held_out")
    assert found.filter("predicted <> toxic").count() == 0
    assert len(model.buckets) < 2000


def test_scores_of_odd_texts(spark, documents, labels):
    model = toxicity.learn(documents, labels)
    odd = frame(spark, [(1, None), (2, ""), (2, ""), (None, "words"), (4, "x " * 400000)])
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    untaught = toxicity.score(odd, toxicity.learn(documents, labels.filter("false"))).collect()
    assert {r.score for r in untaught} == {0.5}


# ---- personal data ----

CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def checked(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else sum(map(int, str(2 * d))) for k, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(8)
    pieces = ["a", "b.c", "@", "x@y.z", ".", "-", " ", "+", "1", "255", "256", "0", "4111 1111 1111 1111", "+1 (456) 555-2186", "é", "_%", "\n", "1.2.3.4", "("]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        expected = [(k, m.start(), m.end()) for k, p in CONTRACT.items() for m in re.finditer(p, text) if checked(k, m.group())]
        expected.sort(key=lambda s: (s[1], list(CONTRACT).index(s[0])))
        assert [tuple(s) for s in pii.base_spans(text)] == expected, text


def test_added_spans_overlap_no_base_span_and_redaction_takes_all(spark, documents):
    trees = pii.learn(documents)
    rows = pii.find(documents, trees).join(documents, "doc_id").collect()
    for r in rows:
        base = {tuple(s) for s in pii.base_spans(r.text)}
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert base <= set(spans)
        assert all(b <= c or d <= a for k, a, b in set(spans) - base for _, c, d in base)
    changed = pii.redacted(documents, trees)
    assert changed.columns == documents.columns
    assert not [r for r in changed.collect() if pii.base_spans(r.text)]


def test_written_out_and_bent_spans_are_taken(spark):
    """As many wide forms as base spans, and implausible look-alikes: most of the first are added, few of the others."""
    rng = random.Random(9)
    word = lambda n=6: "".join(rng.choice("abcdefgh") for _ in range(n))
    number = lambda: f"{rng.randrange(200, 999)}-{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
    rows, wide, other = [], [], []
    for k in range(400):
        rows += [(len(rows), f"write to {word()}@{word()}.com or {word()} call +1 {number()} now")]
        wide += [len(rows), len(rows) + 1]
        rows += [(len(rows), f"write to {word()} at {word()} dot com please"), (len(rows) + 1, f"write or call 1 {number()} please")]
        other += [len(rows), len(rows) + 1]
        rows += [(len(rows), f"we met at {word()}. Then we left"), (len(rows) + 1, f"on 20{rng.randrange(10, 24)}-{rng.randrange(10, 13)}-{rng.randrange(10, 28)} 10 it was {rng.randrange(10**9, 10**10)}")]
    documents = frame(spark, rows)
    found = {r.doc_id: r.spans for r in pii.find(documents, pii.learn(documents)).collect()}
    assert sum(bool(found[k]) for k in wide) > 0.95 * len(wide)
    assert sum(bool(found[k]) for k in other) < 0.02 * len(other)
    alone = frame(spark, [(1, "mail joe at example dot com today")])
    assert pii.redacted(alone, pii.learn(alone)).first().text == "mail <email> today"


def test_no_example_is_left_out_of_fit_and_thresholds(spark, documents, monkeypatch):
    """With far more distinct vectors than allowed, all examples still count."""
    expected = np.array([0, 0, 0, 0])
    for batch in documents.select("text").filter("text IS NOT NULL").mapInArrow(pii._vectors, "vector array<int>, hits long, n long, held_hits long, held_n long").collect():
        expected += [batch.hits, batch.n, batch.held_hits, batch.held_n]
    seen, fit, calibrate = [], pii.fit, pii.thresholds
    monkeypatch.setattr(pii, "fit", lambda vectors, hits, n: seen.append((hits.sum(), n.sum(), len(n))) or fit(vectors, hits, n))
    monkeypatch.setattr(pii, "thresholds", lambda kinds, chance, hits, n: seen.append((hits.sum(), n.sum())) or calibrate(kinds, chance, hits, n))
    fixed = np.array(list(pii._seeds().values())).sum(axis=0)
    sizes = []
    for most in (50_000, 20):
        monkeypatch.setattr(pii, "MAX_VECTORS", most)
        seen.clear()
        pii.learn(documents)
        assert seen[0][:2] == tuple(expected[:2] + fixed) and seen[-1] == tuple(expected[2:] + fixed)
        sizes.append(seen[0][2])
    assert sizes[1] < sizes[0]


def test_boosted_trees_learn_a_rule():
    rng = np.random.default_rng(1)
    vectors = rng.integers(0, 8, (500, len(pii.FEATURES)))
    vectors[:, 0] = 0
    hits = ((vectors[:, 3] > 4) & (vectors[:, 5] < 4)).astype(float)
    trees = pii.fit(vectors, hits, np.ones(500))
    assert ((pii.scores(vectors, trees) > 0.5) == hits.astype(bool)).mean() > 0.99 and trees.thresholds["email"] < 1


def test_long_runs_of_digits_and_letters_are_linear(spark):
    rows = frame(spark, [(1, "9" * 300000), (2, "a" * 300000), (3, "a@" * 50000), (4, None), (5, "")])
    found = {r.doc_id: r for r in pii.find(rows, pii.learn(rows)).collect()}
    assert found[4].spans == found[5].spans == "" and found[4].base_sha256.startswith("e3b0c442")


# ---- decontamination ----


def test_masks_miss_no_window_with_two_substitutions():
    assert decontamination.lossless(decontamination.MASKS)
    assert not decontamination.lossless(decontamination.MASKS[:1])


def test_substituted_passages_are_found(spark):
    rng = random.Random(4)
    item = [f"q{k}" for k in range(25)]
    rows, expected = [], {}
    for doc in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 60))]
        copied = item[:]
        wrong = rng.randrange(0, 9)
        for k in rng.sample(range(25), wrong):
            copied[k] = f"s{rng.randrange(10**6)}"
        same = [a == b for a, b in zip(copied, item)]
        best = max(sum(same[s:s + 12]) for s in range(14))
        at = rng.randrange(len(words) + 1)
        rows.append((doc, " ".join(words[:at] + copied + words[at:]).upper()))
        if best >= 10:
            expected[doc] = best
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, "only six words are in this".upper()), (3, "too short"), (4, None), (None, " ".join(item))], "item_id bigint, text string")
    rows += [(100, "x only six words are in this y"), (101, "six words are in this"), (102, None), (None, " ".join(item))]
    found = decontamination.overlaps(frame(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id): r.matched for r in found} == {(d, 1): m for d, m in expected.items()} | {(100, 2): 6}
    kept = decontamination.decontaminated(frame(spark, rows), benchmark)
    assert kept.count() == len(rows) - len(expected) - 1
    assert decontamination.overlaps(frame(spark, rows), benchmark.filter("false")).count() == 0


# ---- quality ----


def test_hosts_with_many_failures_lose_their_good_documents(spark):
    good = " ".join(f"w{k}" for k in range(60))
    rows = [(k, "bad words", "dump") for k in range(40)] + [(100, good, "dump"), (101, good, "fine"), (102, good, None), (103, "bad", "rare")]
    rows += [(200 + k, good, f"host{k % 9}") for k in range(90)]
    found = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert not found[100].kept and not found[100].base_failed and found[101].kept and found[102].kept and not found[103].kept
    assert all(found[200 + k].kept for k in range(90))


# ---- mixing ----


def test_rates_bring_domains_to_their_targets(spark, documents, labels):
    model = mixing.learn(documents, mixing.labelled_domains(labels))
    memberships = mixing.posteriors(documents, model).cache()
    total = memberships.agg(F.sum("n_tokens")).first()[0]
    wanted = np.array([mixing.TARGETS[d] for d in model.domains]) * total
    moves = mixing.fit_rates(memberships, wanted)
    rated = memberships.withColumn("rate", mixing._rate(moves))
    found = rated.agg(*(F.sum(F.col("rate") * F.col("n_tokens") * F.col("membership")[k]) for k in range(len(wanted)))).first()
    assert np.allclose(found, wanted, rtol=0.01, atol=0.002 * total) and rated.filter("rate < 0").count() == 0


def test_mixing_without_labels_keeps_every_row(spark, documents, labels):
    few = documents.limit(20).withColumn("mix_rate", F.lit("old")).withColumn("_id", F.lit(1))
    mixed = mixing.mixed(few, labels.filter("false"))
    assert mixed.count() == 20 and mixed.filter("mix_rate <> 1.0 OR mix_copies <> 1").count() == 0 and "_id" in mixed.columns


# ---- preferences ----


def brute_pair(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    show = lambda turns: "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)

    def mask(turns):
        out, at = [], 0
        for r, t in turns:
            if r == "assistant":
                out.append(f"{at + len(r) + 5}:{at + len(r) + 5 + len(t) + 7}")
            at += len(show([(r, t)]))
        return ",".join(out)

    return n, show(chosen[:n]), show(chosen[n:]), show(rejected[n:]), mask(chosen[n:]), mask(rejected[n:])


def test_pairs_equal_brute_force_across_blocks(spark):
    rng = random.Random(6)
    pairs = {}
    for k in range(30):
        shared = [(rng.choice(("user", "assistant", "system")), f"t{rng.randrange(5)} é") for _ in range(rng.choice((0, 1, 3, 70, 130)))]
        pairs[k] = tuple(shared + [(rng.choice(("user", "assistant")), f"{rng.randrange(3)}") for _ in range(rng.randrange(0, 80))] for _ in "ab")
    turns = lambda side: spark.createDataFrame(
        [(k, n, r, t, "x") for k, both in pairs.items() for n, (r, t) in enumerate(both[side])] + [(None, 0, "user", "lost", "x")],
        "pair_id bigint, turn bigint, role string, text string, block string",
    )
    found = {r.pair_id: tuple(r)[1:] for r in preferences.preference_pairs(turns(0), turns(1)).collect()}
    assert found == {k: brute_pair(*both) for k, both in pairs.items() if both[0] or both[1]}


def test_repeated_and_null_turns(spark):
    schema = "pair_id bigint, turn bigint, role string, text string"
    chosen = spark.createDataFrame([(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, None, "user", "lost")], schema)
    row = preferences.preference_pairs(chosen, spark.createDataFrame([], schema)).collect()
    assert [tuple(r) for r in row] == [(1, 0, "", "<|user|>\nhi<|end|>\n<|assistant|>\n<|end|>\n", "", "33:40", "")]


# ---- pages ----


@pytest.mark.parametrize("page, text", [
    ("<p>a<p>b", "a\n\nb"),
    ("<ul><li>a<li>b<ol><li>c<li>d</ol></ul>", "- a\n- b\n\n  1. c\n  2. d"),
    ("<table><tr><th>Name<th>N<tr><td>apple<td>10<tr><td>fig<td>2</table>", "Name  | N\napple | 10\nfig   | 2"),
    ("<head><title>t</title></head><body>x<script>var a='</p>';</script><style>p{}</style> y", "x y"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<div hidden>no</div><div style='display: none'>no</div><span>yes</span>", "yes"),
    ("<pre>a\n  b</pre>", "a\n  b"),
    ("one  &amp;\n two &lt;b&gt;", "one & two <b>"),
    ("<!-- x --><h1>T</h1>text<blockquote>q</blockquote>", "T\n\ntext\n\n  q"),
    ("<b>bold<i>both</b>still</i>", "boldbothstill"),
    ("a < b and c<3 <p", "a < b and c<3 <p"),
    ("<details><summary>s</summary>closed</details>", "s"),
    ("", ""),
])
def test_visible_text(page, text):
    assert rendering.rendered(page) == text


@pytest.mark.parametrize("page", [
    "<table><tr><form><td>A1</td><td>B2</td></form></tr></table>C3",
    "<form>A1<table><tbody><form><tr><td>B2</td></tr></form></tbody></table>C3</form>",
    "<table><tr>A1<td>B2</td>C3</tr></table>",
    "<table><tr><center>A1</center><td>B2</td></tr><tr><center><td>C3</table>",
    "<table>A1<tbody>B2<tr><td>C3</table>",
    "<table><thead><div>A1<tr><td>B2</td></tr></div></thead><p>C3</table>",
    "<table><caption>A1</caption><colgroup>B2<col><tr><td>C3</table>",
    "<table><tr><td><table><tr>A1<td>B2</table></td>C3</tr></table>",
    "<table><table><tr><td>A1</table>B2<br>C3</table>",
    "<select><option>A1<option>B2</select>C3",
    "<table><tr><select><option>A1</option></select><td>B2<td>C3</table>",
    "<svg><title>no</title><text>A1</text><g><text>B2</text></g></svg><math><mi>C3</mi></math>",
    "<table>" * 150 + "<tr><td>A1" + "<table><tr>" * 120 + "B2<td>C3",
])
def test_every_text_of_a_malformed_table_is_kept(page):
    found = rendering.rendered(page)
    assert all(found.count(piece) == 1 for piece in ("A1", "B2", "C3")) and "no" not in found


def test_a_form_between_rows_and_cells_changes_no_table():
    rows = ["<tr><td>apple<td>10</tr>", "<tr><td>fig<td>2</tr>"]
    assert rendering.rendered(f"<table><form>{rows[0]}<tr><form><td>fig<td>2</form></tr></form></table>") == "apple | 10\nfig   | 2"


def test_pages_of_odd_form(spark):
    rows = [(1, "u", None), (2, None, "<div>" * 5000 + "deep"), (3, "u", "<table>" * 300 + "x"), (None, "u", "<a href='" + "x" * 10**6)]
    found = {r.page_id: r.text for r in rendering.visible_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found[1] is None and found[2] == "deep"


# ---- language models ----


def test_texts_like_the_target_lose_less(spark):
    rows = [(k, " ".join(("sun sea sand" if k % 2 else "tax form fee").split() * 20)) for k in range(40)]
    table = frame(spark, rows + [(100, None), (101, "unseen words only")])
    found = {r.doc_id: r for r in lm_scoring.score(table, lm_scoring.learn(table, spark.createDataFrame([(1,), (3,), (None,)], "doc_id bigint"))).collect()}
    assert found[5].difference < 0 < found[4].difference and found[100].n_tokens == 0 and found[100].difference == 0


def test_every_context_sums_to_one():
    counts = np.random.default_rng(0).integers(0, 5, (lm_scoring.SIZE, lm_scoring.SIZE)).astype(float)
    counts[:, lm_scoring.BOUNDARY] = 0
    counts[7] = 0
    chances = np.exp(-lm_scoring.losses(counts))[:, :lm_scoring.BOUNDARY].sum(axis=1)
    assert np.allclose(chances, 1)


def test_words_outside_a_fixed_list_tell_texts_apart(spark, monkeypatch):
    """Four words, rarer per text than 1,022 others: texts of such words alone score by which words they are."""
    common = " ".join(f"c{k}" for k in range(1022))
    rows = [(k, common) for k in range(9)] + [(10, "sun sea " * 2), (11, "sun sea " * 2), (20, "tax fee " * 2), (None, "tax fee " * 2), (30, None), (31, " ")]
    target = spark.createDataFrame([(10,), (None,)], "doc_id bigint")
    listed = {r.doc_id: r.difference for r in lm_scoring.score(frame(spark, rows), lm_scoring.learn(frame(spark, rows), target)).collect()}
    assert listed[10] == listed[20]  # both four unknown words
    for share in (lm_scoring.HOT_SHARE, 0.9):  # all pairs broadcast, all pairs joined
        monkeypatch.setattr(lm_scoring, "HOT_SHARE", share)
        found = lm_scoring.score_by_every_word(frame(spark, rows), target).collect()
        by_id = {r.doc_id: r for r in found}
        assert len(found) == len(rows) and by_id[30].n_tokens == by_id[31].n_tokens == by_id[30].difference == 0
        assert by_id[10].difference < 0 < by_id[20].difference
        assert by_id[11].difference == pytest.approx(by_id[10].difference) and by_id[None].difference == pytest.approx(by_id[20].difference)
    few = lm_scoring.score_by_every_word(frame(spark, rows[9:]), target.filter("false"))
    assert few.count() == len(rows) - 9
