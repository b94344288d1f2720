"""Operators 1 to 10 against brute force, round trips and held-out accuracy, with nulls, ties, repeats and empty tables."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS, SF
from tidewheel.llm import chat, decontamination, language_id, line_dedup, mixing, near_dup, quality_lm, queries, sharding, topk, toxicity
from tidewheel.llm.graph import connected_components

WORDS = [a + b + c for a in "bdfgk" for b in "aeiou" for c in ("l", "nd", "rs")]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, len(t or "")) for i, t, lang, src in rows], DOCS)


ODD = [(1, None, None, None), (2, "", "en", "a"), (None, "only here", "en", None), (3, " \n\t ", "xx", "b"), (3, "x", None, "b"), (4, "same " * 30, "en", "a"), (5, "same " * 30, "en", "b"), (5, "same " * 30, "en", "b")]


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD + [(6, prose(1, 20_000), "en", "long")]).withColumns({"score": F.lit("s"), "shard": F.lit(-1), "node": F.lit(0), "h1": F.lit(1), "copies": F.lit(9)})


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


# toxicity


def test_toxicity_held_out(spark):
    rows = [(i, prose(i, 40) + (" vilescum rotter" if i % 3 == 0 else ""), "en", "a") for i in range(300)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    model = toxicity.train(docs.filter("doc_id < 200"), labels.filter("doc_id < 200"))
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model, ["doc_id"]).collect()}
    assert all((got[i] >= 0.5) == (i % 3 == 0) for i in range(200, 300))


def test_toxicity_odd_inputs(spark, odd, none):
    labels = spark.createDataFrame([(2, None, 1), (2, None, 0), (None, 1, 1), (4, 0, None)], "doc_id long, quality int, toxic int")
    for docs in (odd, none):
        model = toxicity.train(docs, labels)
        out = toxicity.scored(docs, model)
        assert out.count() == docs.count() and set(out.columns) == set(docs.columns) | {"score"}
        assert all(0 <= r.score <= 1 for r in out.collect())


def test_toxicity_scores_by_hand(spark):
    """A score is the logistic of the intercept and the weights of a text's different n-grams; 0.5 counts as toxic."""
    r = np.random.default_rng(7)
    weight, bias = r.normal(0, 0.2, 1 << toxicity.BITS).astype(np.float32), -0.3
    texts = ["", None, "ab", "Ab  ab\tab", "é😀 " * 9, prose(3, 3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", F.lit("s"))
    got = {x.doc_id: (x.s, x.score) for x in toxicity.scored(docs, (weight, bias), name="s").collect()}
    for i, t in enumerate(texts):
        z = bias + sum(float(weight[b]) for b in set(toxicity.buckets(t).tolist()))
        assert math.isclose(got[i][0], 1 / (1 + math.exp(-z)), rel_tol=1e-6) and got[i][1] == "s"
    grams = {t[k : k + n] for t in [" ab ab ab "] for n in toxicity.ORDERS for k in range(len(t) - n + 1)}
    assert len(set(toxicity.buckets(texts[3]).tolist())) == len(grams)
    ties = spark.createDataFrame([(0.5,), (0.4999999,), (0.0,), (1.0,)], "score double")
    assert [x.p for x in ties.select(toxicity.predicted(F.col("score")).alias("p")).collect()] == [1, 0, 0, 1]


def test_toxicity_weights_follow_the_ratios():
    """n-grams of few documents, or as frequent in either label, get no weight; the others weigh towards their label."""
    r = random.Random(1)
    rows = [(" ".join(r.choice(WORDS) for _ in range(20)) + (" vilescum" if k % 4 == 0 else "") + (" onlyonce" if k == 0 else "") + (" friendly" if k % 4 == 1 else ""), k % 4 == 0) for k in range(200)]
    features = [toxicity.packed(np.unique(toxicity.buckets(t))) for t, _ in rows]
    weight, _ = toxicity.fit(np.array([float(y) for _, y in rows]), features)
    of = lambda word: weight[np.setdiff1d(toxicity.buckets(word), toxicity.buckets(" ".join(WORDS)))]
    assert of("vilescum").max() > 0 and of("vilescum").min() >= 0 and of("friendly").max() <= 0 > of("friendly").min()
    assert not weight[np.setdiff1d(toxicity.buckets("xonlyoncex"), toxicity.buckets("vilescum friendly " + " ".join(WORDS)))].any()


def brute_grams(text):
    """The buckets of a text's n-grams, character by character in whole numbers."""
    plain, mix, out = f" {' '.join(text.lower().split())} ", 0x9E3779B97F4A7C15, set()
    for n in (3, 4, 5, 6):
        for k in range(len(plain) - n + 1):
            h = 0
            for c in plain[k : k + n]:
                h = (h * mix + ord(c)) % (1 << 64)
            out.add(((h ^ (h >> 29)) * (mix + 2 * n) % (1 << 64)) >> 44)
    return out


def test_toxicity_fit_against_brute_force():
    """Document frequencies, log-count ratios, which n-grams count, and the logistic steps, over dense arrays of doubles."""
    r = random.Random(9)
    texts = [" ".join(r.choice(WORDS) for _ in range(r.randrange(3, 25))) + (" vilescum" if k % 3 == 0 and k % 4 else "") + (" Rotten é" if k % 9 == 0 else "") + (" kindly" if k % 3 == 1 else "") for k in range(150)]
    toxic = np.array([float(k % 3 == 0) for k in range(150)])
    sets = [brute_grams(t) for t in texts]
    assert all(s == set(toxicity.buckets(t).tolist()) for s, t in zip(sets, texts))
    weight, bias = toxicity.fit(toxic, [toxicity.packed(np.array(sorted(s))) for s in sets])

    n, n1 = len(texts), toxic.sum()
    grams = sorted(set().union(*sets))
    has = np.array([[g in s for g in grams] for s in sets], float)
    pos, neg = has[toxic > 0].sum(0), has[toxic == 0].sum(0)
    ratio = np.log((pos + 1) / (n1 + 2)) - np.log((neg + 1) / (n - n1 + 2))
    df, share = pos + neg, n1 / n
    z = (pos - df * share) / np.sqrt(np.maximum(df * share * (1 - share) * (1 - df / n), 1e-3))
    used = (df >= 3) & (np.abs(z) >= 4.0)
    assert used.any() and set(np.flatnonzero(weight)) <= {g for g, u in zip(grams, used) if u}
    x = has[:, used] * ratio[used]
    scale = np.mean(np.sqrt(np.maximum(1.0, (x**2).sum(1))))
    x, w, square, b, b_square = x / scale, np.zeros(used.sum()), np.full(used.sum(), 1e-6), math.log(4.0 * n1 / (n - n1)), 1e-6
    draw = np.random.default_rng(1)
    for _ in range(max(15, 600 // (n // 64))):
        for part in np.array_split(draw.permutation(n), n // 64):
            err = (1 / (1 + np.exp(-(x[part] @ w + b))) - toxic[part]) * np.where(toxic[part] > 0, 4.0, 1.0)
            met = has[part][:, used].any(0)
            grad = np.where(met, x[part].T @ err / len(part) + 1e-4 * w, 0)
            square += grad**2
            w -= 0.1 * grad / np.sqrt(square)
            b_square += err.mean() ** 2
            b -= 0.1 * err.mean() / np.sqrt(b_square)
    got = weight[np.array(grams)[used]]
    assert np.allclose(got, w * ratio[used] / scale, rtol=5e-3, atol=2e-3) and abs(bias - b) < 5e-3


def test_op1_query(spark):
    out = queries.op1_toxicity(spark, SF)
    rows = out.collect()
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in rows)


# line dedup


def brute_lines(rows, sites):
    seen = defaultdict(set)
    for _, t, _, s in rows:
        for x in (t or "").split("\n"):
            if x.strip(" "):
                seen[x.strip(" ")].add(s)
    bad = {x for x, s in seen.items() if len(s) >= sites}
    return Counter((i, t if t is None else "\n".join(x for x in t.split("\n") if x.strip(" ") not in bad)) for i, t, _, _ in rows)


def test_lines(spark, odd, none):
    rows = [(i, "\n".join([f"head {i % 7}", "", prose(i, 5), " shared footer ", "own" if i < 9 else "none"]), "en", f"s{i % (i % 7 + 1)}") for i in range(60)] + ODD
    for sites in (1, 2, 5):
        out = line_dedup.remove_boilerplate(documents(spark, rows), sites).collect()
        assert Counter((r.doc_id, r.text) for r in out) == brute_lines(rows, sites)
    assert line_dedup.remove_boilerplate(odd).count() == odd.count()
    assert line_dedup.remove_boilerplate(none).count() == 0


# language


def test_language(spark, odd, none):
    def speak(lang, seed, n):
        r = random.Random(seed)
        return " ".join("".join(r.choice({"aa": "abcdeh", "bb": "eilmno", "cc": "rstuvw"}[lang]) for _ in range(5)) for _ in range(n))

    docs = documents(spark, [(k * 100 + i, speak(lang, k * 100 + i, 30), lang, "s") for k, lang in enumerate(("aa", "bb", "cc")) for i in range(30)])
    samples = language_id.sample_text(docs.filter("doc_id % 2 = 0"))
    out = language_id.identify(docs, samples, ["doc_id", "lang"]).collect()
    assert all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in out)
    got = {(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(odd, samples, ["doc_id"]).collect() if r.doc_id in (1, 2)}
    assert got == {(1, "und", 0.0), (2, "und", 0.0)}
    assert {r.lang_pred for r in language_id.identify(docs, {}, ["doc_id"]).collect()} == {"und"}
    assert language_id.identify(none, samples, ["doc_id"]).count() == 0


def brute_phrases(text, sample):
    n, at = 0, 0
    while at < len(text):
        k = at
        while k < len(text) and text[at : k + 1] in sample:
            k += 1
        n, at = n + 1, max(k, at + 1)
    return n


def test_parse_counts_phrases():
    sample = {"x": "abracadabra"}
    table = language_id.letter_numbers(sample)
    step, roots, own, _ = language_id.transducers(sample, table)
    for text in ("abra", "abraabra", "cadab", "bbb", "rad", "abxra", "xx", "xab", "abx", ""):
        assert language_id.phrases([language_id.numbers(text, table)], step, roots, own)[0, 0] == brute_phrases(text, sample["x"])


def test_language_against_brute_force(spark):
    """Small samples, few letters: the prediction is the language of the fewest phrases times log2 of its sample's length."""
    r = random.Random(3)
    say = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    samples = {"aa": say("abcd", 300), "bb": say("bcde", 2000), "cc": say("cdef", 700)}
    texts = [say(r.choice(["abcd", "bcde", "cdef"]), r.randrange(1, 200)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.lang_pred, x.score) for x in language_id.identify(docs, samples, ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        n = {k: brute_phrases(t, x) * math.log2(len(x) + 1) for k, x in samples.items()}
        best, *rest = sorted(n, key=lambda k: (n[k], k))
        assert got[i][0] == best and math.isclose(got[i][1], 1 - n[best] / n[rest[0]], abs_tol=1e-9)


def test_every_language_is_learned(spark):
    """One text in 2000 copies, fifty texts, one very long text, and scripts beyond the alphabetic ones."""
    r = random.Random(4)
    han, kana = [chr(0x4E00 + 7 * k) for k in range(500)], [chr(0x3042 + k) for k in range(60)]
    say = {
        "en": lambda n: " ".join(r.choice(["the", "and", "of", "house", "with", "thing"]) for _ in range(n)), "fr": lambda n: " ".join(r.choice(["le", "et", "maison", "avec", "chose", "été"]) for _ in range(n)),
        "xl": lambda n: " ".join(r.choice(["zzyx", "qoqo", "wuxu", "vyx"]) for _ in range(n)), "zh": lambda n: "".join(r.choice(han) for _ in range(n)), "ja": lambda n: "".join(r.choice(kana + han[:80]) for _ in range(n)),
        "ru": lambda n: " ".join(r.choice(["дом", "и", "вещь", "один"]) for _ in range(n)),
    }
    rows = [(i, x, "en", "a") for i, x in enumerate([say["en"](60)] * 2000)] + [(3000 + i, say["fr"](60), "fr", "a") for i in range(50)] + [(4000, say["xl"](20_000), "xl", "b")]
    rows += [(5000 + k * 100 + i, say[lang](400), lang, "c") for k, lang in enumerate(("zh", "ja", "ru")) for i in range(12)]
    samples = language_id.sample_text(documents(spark, rows))
    assert set(samples) == set(say) and all(0 < len(t) <= language_id.SAMPLE_CHARS for t in samples.values())
    asked = [(k * 10 + i, say[lang](80), lang, "q") for k, lang in enumerate(say) for i in range(5)]
    assert all(x.lang == x.lang_pred for x in language_id.identify(documents(spark, asked), samples, ["doc_id", "lang"]).collect())


def test_op3_query(spark):
    rows = queries.op3_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


# sharding


def test_sharding(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard(docs, 5).collect()
    size = Counter()
    slots = defaultdict(list)
    for r in rows:
        assert r.size == len((r.text or "").encode()) + 16 and r.text_crc32 == zlib.crc32((r.text or "").encode())
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(rows) == docs.count() and set(size) == set(range(5))
    assert max(size.values()) <= 1.02 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    out = sharding.shard(odd, 3)
    assert out.count() == odd.count() and "copies" in out.columns
    assert sharding.shard(none, 3).count() == 0


def test_map_is_edited_across_runs(spark, tmp_path):
    """The next version comes from the newest one, also with a shard more or less, and earlier versions stay as they are."""
    path = f"file://{tmp_path}/map"
    docs = documents(spark, [(i, prose(i, 5 + i % 60), "en", "a") for i in range(2000)])
    size = lambda rows: Counter(s for r in rows for s in [r.shard] for _ in range(r.size))

    def where(n, rows=docs):
        out = sharding.shard(rows, n, 64, path).collect()
        slots = {r.virtual_slot: r.shard for r in out}
        assert len(out) == rows.count() and max(size(out).values()) <= 1.1 * min(size(out).values())
        return slots

    first = where(4)
    assert sharding.newest_version(spark, path) == 2
    old = sharding.read_map(spark, path, 2)
    assert where(4) == first
    grown = where(5)
    moved = {s for s in first if grown[s] != first[s]}
    assert sharding.newest_version(spark, path) == 4 and 8 <= len(moved) <= 32 and set(grown.values()) == set(range(5))
    assert set(where(3).values()) == {0, 1, 2} and sharding.read_map(spark, path, 2) == old
    with pytest.raises(ValueError, match="64 slots"):
        sharding.shard(docs, 4, 128, path)


def test_rebalance_edits_few():
    sizes = {s: 10 for s in range(40)} | {0: 100}
    before = sharding.first_map(40, 4)
    after = sharding.rebalance(before, sizes, 4)
    totals = Counter()
    for s, shard in enumerate(after):
        totals[shard] += sizes[s]
    assert max(totals.values()) - min(totals.values()) <= 10
    assert sharding.rebalance(after, sizes, 4) == after


# chat


def chat_rows(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, turn long, kind string, role string, text string")


def test_fold_and_round_trip(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nhi", "a\\<|b", "<\\|", "\\\\n", "", "é😀<|<||", "<\\n"]
    events = [
        (1, 1, 0, "message", "user", "hello"), (1, 2, 1, "delta", "assistant", "wo"), (1, 3, 1, "delta", "assistant", "rld"), (1, 4, 2, "message", "user", "more"),
        (1, 5, 1, "regenerate", "assistant", None), (1, 6, 1, "delta", "assistant", "new "), (1, 7, 1, "delta", "assistant", "end"),
        (1, 8, 0, "edit", "user", "hello!"), (None, 1, None, None, None, None), (3, 1, 0, "message", "as\nsist", "x"), (3, 1, 0, "message", "as\nsist", "x"),
        *((2, k, k, "message", "assistant" if k % 2 else "user", t) for k, t in enumerate(nasty)),
    ]
    folded = chat.fold(chat_rows(spark, events))
    got = defaultdict(list)
    for r in folded.orderBy("conv_id", "turn").collect():
        got[r.conv_id].append((r.role, r.text))
    assert got[1] == [("user", "hello!"), ("assistant", "new end")]
    assert got[2] == [("assistant" if k % 2 else "user", t) for k, t in enumerate(nasty)]
    assert got[None] == [("null", "")] and got[3] == [("as\nsist", "x")]
    rendered = chat.render(folded)
    back = defaultdict(list)
    for r in chat.read_back(rendered).orderBy("conv_id", "pos").collect():
        back[r.conv_id].append((r.role, r.text))
        assert r.in_loss == (r.role == "assistant")
    assert back == got
    for r in rendered.filter("conv_id = 2").collect():
        loss = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
        assert [x.replace("<\\|", "<|").replace("\\\\", "\\") for x in loss] == [t for k, t in enumerate(nasty) if k % 2]
    assert chat.digest(chat.render(chat.fold(chat_rows(spark, [])))).count() == 0


def test_chat_of_long_texts_and_own_columns(spark):
    long = prose(5, 20_000) + "<|im_end|>"
    events = chat_rows(spark, [(1, 1, 0, "message", "user", long), (1, 2, 1, "delta", "assistant", long), (1, 3, 1, "delta", "assistant", long)])
    for c in ("pos", "formatted", "loss_spans", "n_turns", "start", "length", "in_loss"):
        events = events.withColumn(c, F.lit("own"))
    got = chat.digest(chat.render(chat.fold(events))).collect()
    assert [(r.n_turns, r.loss_chars) for r in got] == [(2, 2 * len(long))]


# decontamination


def brute_containment(docs, items):
    import regex

    def sets(t):
        w = regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
        return {n: {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} for n in range(1, 6)}, min(len(w), 5)

    out = set()
    ds = [(i, sets(t)[0]) for i, t in docs if i is not None]
    for k, t in items:
        by, n = sets(t)
        out |= {(i, k) for i, s in ds if n and 100 * len(by[n] & s[n]) >= 80 * len(by[n])}
    return out


def test_decontamination(spark, odd, none):
    items = [(k, prose(1000 + k, 10 + 9 * k)) for k in range(8)] + [(90, "two words"), (91, None), (92, "")]
    docs = [(i, prose(i, 60)) for i in range(40)]
    for k in range(8):
        w = items[k][1].split()
        docs.append((100 + k, prose(k, 3000) + " " + items[k][1].upper().replace(" ", ", ") + " " + prose(k + 50, 3000)))
        docs.append((200 + k, prose(k, 9) + " " + " ".join(w[: int(len(w) * 0.9)])))
        docs.append((300 + k, " ".join(w[: len(w) // 2])))
    docs += [(400, "Two  words!"), (401, None), (None, items[0][1]), (100, docs[40][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    rows = decontamination.contaminated(d, i).collect()
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})
    assert {(r.doc_id, r.item_id) for r in rows} == brute_containment(docs, items)
    left = Counter((r.doc_id, r.text) for r in decontamination.clean(d, i).collect())
    assert left == Counter((x, t) for k, (x, t) in enumerate(docs) if not brute_containment([(k, t)], items))
    assert decontamination.contaminated(none, i).count() == 0
    assert decontamination.clean(odd, i.limit(0)).count() == odd.count()


def test_short_items_in_long_documents(spark):
    items = [(1, "secret phrase here"), (2, "Zyx"), (3, "four words in row"), (4, "absent phrase here")]
    docs = [(1, prose(1, 10_000) + " a Secret, phrase HERE " + prose(2, 10_000)), (2, "secret phrase"), (3, "zyx"), (4, "the zyx"), (5, "four words in a row"), (6, "so four words in row")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(d, i).collect()}
    assert got == {(1, 1), (3, 2), (4, 2), (6, 3)} == brute_containment(docs, items)


# near duplicates


def brute_components(rows, words):
    known = near_dup.WordHashes()
    sets = [(i, set(near_dup.shingle_set(t, words, known).tolist())) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1 :]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i, _ in sets}


def near_rows():
    rows, r = [], random.Random(5)
    for g in range(12):
        base = prose(g, 120).split()
        for k in range(1 + g):
            w = list(base)
            for _ in range(k % 7):
                w[r.randrange(len(w))] = r.choice(WORDS)
            rows.append((g * 100 + k, " ".join(w) if k % 3 else " ".join(w).title()))
    return rows + [(5000, None), (5001, ""), (5002, "one"), (5003, "ONE"), (5004, "one two"), (5005, "é É"), (5006, "É é")]


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, words):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1))
    got = {r.doc_id: r for r in near_dup.near_duplicates(docs, words).collect()}
    want = brute_components(rows, words)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == want[i]) for i, r in got.items())


def edited_copies(groups, copies, words, edits):
    rows, r = [], random.Random(11)
    for g in range(groups):
        base = [f"{w}{k}" for k, w in enumerate(prose(g, words).split())]
        for k in range(copies):
            w = list(base)
            for at in r.sample(range(len(w)), r.randrange(*edits)):
                w[at] = f"own{g}x{k}x{at}"
            rows.append((g * 10_000 + k, " ".join(w)))
    return rows


def test_near_duplicates_of_a_large_region(spark, monkeypatch):
    """All classes are one region and the neighbours alone do not find its links; blocks and stars are small."""
    for name, value in {"TREES": 1, "MIN_DEPTH": 0, "NEIGHBOURS": 1, "STAR": 4, "LEFT": (4, 8), "RIGHT": (8, 16), "SLICE": 64}.items():
        monkeypatch.setattr(near_dup, name, value)
    rows = edited_copies(3, 50, 120, (3, 12))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in near_dup.near_duplicates(docs, 2).collect()}
    assert got == brute_components(rows, 2)


def test_near_duplicates_of_a_large_group(spark):
    """Some thousand copies of one text, most near the threshold of each other."""
    rows = edited_copies(1, 1500, 60, (1, 9))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in near_dup.near_duplicates(docs, 2).collect()}
    assert got == brute_components(rows, 2) and len(set(got.values())) > 1


def test_shared_counts():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 9000, n).astype(np.uint64)) for n in (1, 50, 3000, 9000, 20_000)]
    got = near_dup.shared_counts(sets[:3], sets)
    assert got.tolist() == [[len(np.intersect1d(x, y)) for y in sets] for x in sets[:3]]


def test_near_duplicates_odd(spark, odd, none):
    rows = near_dup.near_duplicates(odd, 2).collect()
    assert len(rows) == odd.count()
    assert {r.doc_id: r.component_id for r in rows if r.doc_id in (4, 5)} == {4: 4, 5: 4}
    assert [r.kept for r in rows if r.doc_id is None] == [True]
    assert near_dup.near_duplicates(none, 2).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100}


# quality


def test_kneser_ney_against_brute_force(spark):
    text = "the cat sat on the mat and the hat sat on the cat."
    table = quality_lm.symbol_table()
    docs = documents(spark, [(1, text, "en", "a")])
    bits = quality_lm.dense(quality_lm.kneser_ney(quality_lm.gram_counts(docs)))
    assert len({int(table[ord(c)]) for c in "дождьлес"}) == len(set("дождьлес")) and table[ord("A")] == table[ord("Z")] != table[ord("a")]
    n = Counter(quality_lm.grams(text, table).tolist())
    levels = {4: n}
    for order in (3, 2, 1):
        levels[order] = Counter(g & ((1 << 6 * order) - 1) for g in levels[order + 1])

    def p(order, gram):
        if order == 0:
            return 1 / 64
        level, context = levels[order], gram >> 6
        d = quality_lm.discounts(*(sum(c == k for c in level.values()) for k in (1, 2, 3, 4)))
        of = [(g, c) for g, c in level.items() if g >> 6 == context]
        low = p(order - 1, gram & ((1 << 6 * (order - 1)) - 1))
        if not of:
            return low
        total, cut = sum(c for _, c in of), sum(d[min(c, 3) - 1] for _, c in of)
        c = level.get(gram, 0)
        return (c - (d[min(c, 3) - 1] if c else 0)) / total + cut / total * low

    for gram in [*n, 0, 12345, (5 << 18) | 7]:
        assert math.isclose(float(bits[gram]), -math.log2(p(4, gram)), rel_tol=2e-3)


def test_quality(spark, odd, none):
    rows = [(i, prose(i, 200), "en", "a") for i in range(60)] + [(100 + i, "%%% ### " * 100, "en", "a") for i in range(5)] + [(200, None, None, None), (201, "", "en", "a")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(100, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    found = quality_lm.classify(documents(spark, rows), labels).collect()
    got = {r.doc_id: r.kept for r in found}
    # Perplexities and the threshold by hand: trained on four fifths of the trusted texts, judged by the other fifth.
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0]
    learn = documents(spark, [x for x in rows[:40] if x[0] not in held])
    bits, table = quality_lm.dense(quality_lm.kneser_ney(quality_lm.gram_counts(learn))).astype(np.float64), quality_lm.symbol_table()
    own = {i: 2 ** bits[quality_lm.grams(t, table)].mean() for i, t, *_ in rows if t}
    assert all(math.isclose(r.perplexity, own[r.doc_id]) for r in found if r.doc_id in own)
    assert all(math.isclose(r.threshold, max(own[i] for i in held)) for r in found)
    assert all(r.kept == (r.doc_id in own and own[r.doc_id] <= r.threshold) for r in found)
    assert sum(got[i] for i in range(60)) >= 50 and not any(got[100 + i] for i in range(5)) and not got[200] and not got[201]
    assert quality_lm.classify(odd, labels.limit(0)).count() == odd.count()
    assert quality_lm.classify(none, labels).count() == 0


# mixing


def test_mixing(spark, odd, none):
    rows = [(i, prose(i, 5 + i % 40), "en", ["a", "b", "é", None][i % 4 if i % 3 else 0]) for i in range(800)]
    out = mixing.mix(documents(spark, rows)).collect()
    per = defaultdict(lambda: [0, 0.0, 0])
    for r in out:
        per[r.source][0] += r.copies * r.size
        per[r.source][1], per[r.source][2] = r.target, r.source_size
        assert r.copies * r.size <= 2 * r.size
    assert math.isclose(sum(t for _, t, _ in per.values()), 1.5 * sum(z for *_, z in per.values()))
    assert all(abs(k - t) <= 45 and t <= 2 * z + 1e-9 for k, t, z in per.values())
    again = Counter(r.doc_id for r in mixing.mixed(documents(spark, rows)).collect())
    assert again == Counter({r.doc_id: r.copies for r in out if r.copies})
    assert mixing.mix(odd).count() == odd.count() and set(mixing.mixed(odd).columns) == set(odd.columns)
    assert mixing.mix(none).count() == 0


def test_mixing_of_one_id(spark):
    """One id, or none, with a large share of all texts: its rows are taken one by one."""
    for same in (7, None):
        docs = documents(spark, [(same if i % 2 else i, prose(i, 20 + i % 9), "en", "ab"[i % 3 == 0]) for i in range(600)])
        per = defaultdict(int)
        for r in mixing.mix(docs).collect():
            per[r.source, r.target] += r.copies * r.size
        assert all(abs(n - target) <= 30 for (_, target), n in per.items())


def test_mixing_is_nested(spark):
    docs = documents(spark, [(i, prose(i, 30), "en", "ab"[i % 2]) for i in range(400)])
    small = {r.doc_id for r in mixing.mix(docs, share=0.3).collect() if r.copies}
    large = {r.doc_id for r in mixing.mix(docs, share=0.6).collect() if r.copies}
    assert small < large


# top-k


def brute_top(rows, k):
    ints = {i: np.floor(256 * np.array(v, np.float64)).astype(np.int64) for i, v in rows}
    out = set()
    for q in ints:
        if q % 50 == 0:
            best = sorted(((-int(ints[q] @ ints[i]), i) for i in ints if i != q))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


def test_top_k(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=8).round(2).tolist()) for i in range(900)] + [(1000 + i, [0.5] * 8) for i in range(300)]
    bad = [(5000, None), (5001, [1.0, None]), (5050, [float("nan")] * 8), (5051, [float("inf")] * 8), (None, [1.0] * 8), (1000, [0.5] * 8)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    got = [tuple(x) for x in topk.top_k(df, "pmod(vec_id, 50) = 0").select("query_id", "rank", "vec_id", "score").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_top(rows, 5)
    few = topk.top_k(df.filter("vec_id in (0, 1, 2)"), "pmod(vec_id, 50) = 0").collect()
    assert len(few) == 2
    assert topk.top_k(df.limit(0), "pmod(vec_id, 50) = 0").count() == 0


def test_top_k_beside_own_columns(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for c in ("query", "v", "block", "part", "rank", "score", "query_id"):
        df = df.withColumn(c, F.lit("own"))
    got = {tuple(x) for x in topk.top_k(df, "pmod(vec_id, 50) = 0").select("query_id", "rank", "vec_id", "score").collect()}
    assert got == brute_top(rows, 5)


def test_top_k_in_many_cells(spark, monkeypatch):
    """Clusters, a third of all rows equal, several tasks for a cell and for its queries."""
    for name, value in {"CELL": 40, "LEAST_BLOCK": 16, "SPREAD": 40, "QUERY_BLOCK": 64, "SAMPLE": 200}.items():
        monkeypatch.setattr(topk, name, value)
    r = np.random.default_rng(5)
    middles = r.normal(size=(12, 8)) * 4
    rows = [(i, (middles[i % 12] + r.normal(size=8) / 20).round(2).tolist()) for i in range(1400)] + [(2000 + i, [1.5] * 8) for i in range(700)]
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(x) for x in topk.top_k(df, "pmod(vec_id, 50) = 0").select("query_id", "rank", "vec_id", "score").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_top(rows, 5)


def test_queries_skip_far_cells(spark):
    r = np.random.default_rng(6)
    middles = np.eye(16)[:10] * 5
    rows = [(i, (middles[i % 10] + r.normal(size=16) / 50).tolist()) for i in range(1000)]
    ints = topk.as_integers(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    drawn = ints.orderBy("vec_id").limit(100).toArrow()
    sample = topk.matrix(drawn, 16)
    centres = topk.centres_of(sample.astype(float), 10)
    dealt = topk.dealt(ints, "pmod(vec_id, 50) = 0", 5, sample, drawn.column("vec_id").to_numpy(), centres)
    cells = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"), F.max("norm").alias("longest")).collect()
    assert len(cells) == 10 and all(c.n == 100 for c in cells)
    assert topk.asked_cells(dealt.filter("query").select("vec_id", "v", "floor"), sample[centres], cells).count() == 20


def test_bound_holds():
    r = np.random.default_rng(7)
    for spread in (0.1, 1.0, 5.0):
        a, b = r.normal(size=(60, 6)) * spread + r.normal(size=6), r.normal(size=(60, 6)) * spread + r.normal(size=6)
        _, x = topk.cover_tree(a)
        _, y = topk.cover_tree(b)
        assert topk.bound(x.centre @ y.centre, x.norm, y.norm, x.radius, y.radius, x.longest, y.longest) >= (a @ b.T).max()


def test_cover_tree_covers():
    r = np.random.default_rng(1)
    points = np.concatenate([r.normal(size=(700, 4)), np.ones((200, 4))])
    order, root = topk.cover_tree(points)
    assert sorted(order) == list(range(900))
    stack = [root]
    while stack:
        n = stack.pop()
        assert (np.linalg.norm(points[order[n.low : n.high]] - n.centre, axis=1) <= n.radius + 1e-9).all()
        if n.children:
            assert [n.low, *(c.high for c in n.children)] == [*(c.low for c in n.children), n.high]
        stack += n.children


def test_without_places(spark):
    from pyspark.sql import functions as F

    from tidewheel.llm.line_dedup import without

    n = 200_000
    rows = [("a\nb\nc", [1]), ("a\nb\nc", [0, 1, 2]), ("a", [0]), ("a\n\nb", [0, 2]), ("\n".join(map(str, range(n))), list(range(0, n, 2)))]
    df = spark.createDataFrame(rows, "text string, gone array<int>")
    got = [r[0] for r in df.select(without(F.split("text", "\n"), F.col("gone"))).collect()]
    for (text, gone), left in zip(rows, got, strict=True):
        hidden = set(gone)
        assert left == [x for i, x in enumerate(text.split("\n")) if i not in hidden]


# columns of the operators' own names, and rows that once did harm


def test_names_of_the_operators_own(spark, odd):
    """Input columns named as those made inside, and columns without an order, pass through."""
    docs = odd.withColumns({c: F.lit(7) for c in ("__key", "__gone", "__row", "__whole", "good_id", "label_id", "features", "l1", "own", "held_out", "n_lines", "n_removed")})
    docs = docs.withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    out = line_dedup.remove_boilerplate(docs)
    assert out.columns == [c for c in docs.columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    assert {(r["__key"], r["__gone"], r["__row"], r["__whole"]) for r in out.collect()} == {(7, 7, 7, 7)} and out.count() == docs.count()
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 1), (6, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality_lm.classify(docs, labels).count() == docs.count()
    model = toxicity.train(docs, labels)
    assert toxicity.scored(docs.drop("m"), model).count() == docs.count()
    kept = near_dup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id = 5").isEmpty() and kept.filter("doc_id = 4").count() == 1


def test_toxicity_takes_one_row_of_an_id(spark):
    """A labelled id with very many rows gives the fit one row, whichever task its rows are in."""
    rows = [(1, prose(k, 5), None, None) for k in range(400)] + [(2, "b", None, None), (2, "b", None, None)]
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.training_rows(documents(spark, rows).repartition(6), labels, 10).collect()
    assert sorted(r.label for r in got) == [0, 1]
    least = min(toxicity.packed(np.unique(toxicity.buckets(t))) for i, t, *_ in rows if i == 1)
    assert bytes(next(r.features for r in got if r.label == 1)) == least


def test_parts_by_bytes():
    import pyarrow as pa

    from tidewheel.llm.common import by_bytes

    batch = pa.record_batch([pa.array(["x" * 50, None, "", "y" * 5, "z" * 4, "w" * 90, "v"]), pa.array(range(7))], ["text", "k"]).slice(1)
    for rows, size in ((2, 1_000), (10, 9), (10, 1), (1, 1)):
        parts = list(by_bytes(batch, "text", rows, size))
        assert [k for p in parts for k in p.column("k").to_pylist()] == list(range(1, 7))
        assert all(p.num_rows == 1 or p.num_rows <= rows and sum(len(t or "") for t in p.column("text").to_pylist()) <= size for p in parts)
    assert list(by_bytes(batch.slice(0, 0), "text", 2, 2)) == []


def test_language_does_not_depend_on_the_parts(spark, monkeypatch):
    docs = documents(spark, [(i, prose(i, 30 * (i % 5)), "ab"[i % 2], None) for i in range(40)])
    samples = language_id.sample_text(docs.select("text", "lang"))
    whole = sorted(map(tuple, language_id.identify(docs, samples, ["doc_id"]).collect()))
    monkeypatch.setattr(language_id, "PART_BYTES", 100)
    assert sorted(map(tuple, language_id.identify(docs, samples, ["doc_id"]).collect())) == whole
