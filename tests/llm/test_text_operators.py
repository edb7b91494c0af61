"""Language, toxicity, language model and page text on odd inputs and planted cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spinledger.llm import htmltext, langid, maxent, toxicity

EN = "the cat and the dog went to the house with a friend of mine when it was raining "
DE = "der hund und die katze gingen mit einem freund in das haus als es geregnet hat "


def many(spark, texts, langs=None):
    rows = [(i, t, (langs or ["en"] * len(texts))[i]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_mixed_texts(spark):
    texts = [(EN if i % 2 else DE) * (1 + i % 3) for i in range(60)]
    model = langid.learn(many(spark, texts, ["en" if i % 2 else "de" for i in range(60)]))
    mixed = EN * 3 + "\n" + DE
    ((lang, score, spans), (other, _, _), (none, zero, _)) = langid.predict(
        [mixed, DE, "123 !!"], model
    )
    assert (lang, other, none, zero) == ("en", "de", "und", 0.0)
    assert [s["lang"] for s in spans] == ["en", "de"]
    assert mixed[spans[1]["start"] : spans[1]["end"]].startswith("der hund")
    assert 0.5 < score < 1


def test_viterbi_matches_all_paths():
    rng = np.random.default_rng(3)
    lengths = np.array([4, 0, 1, 5])
    scores = rng.normal(0, 10, (10, 3))
    labels = langid.viterbi(scores, lengths)
    low = 0
    for n in lengths:
        own = scores[low : low + n]
        paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), -1).reshape(-1, n) if n else []
        if n:
            value = own[np.arange(n), paths].sum(1) - langid.SWITCH * (paths[:, 1:] != paths[:, :-1]).sum(1)
            assert (paths[value.argmax()] == labels[low : low + n]).all()
        low += n


def test_language_of_odd_rows(odd, none, clashing):
    for docs in (odd, clashing):
        rows = langid.identified(docs).collect()
        assert len(rows) == odd.count()
        for row in rows:
            assert 0 <= row.score <= 1
        assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 9)} == {"und"}
    assert langid.identified(none).count() == 0


def test_script_rules_languages_out(spark):
    greek = "ο σκύλος και η γάτα πήγαν στο σπίτι "
    model = langid.learn(many(spark, [EN] * 10 + [greek] * 10, ["en"] * 10 + ["el"] * 10))
    assert [p[0] for p in langid.predict(["σπίτι", "house"], model)] == ["el", "en"]


def test_automaton_edits_anywhere():
    def distance(a, b):
        rows = [list(range(len(b) + 1))]
        for i, x in enumerate(a, 1):
            rows.append([i])
            for j, y in enumerate(b, 1):
                best = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (x != y))
                if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                    best = min(best, rows[i - 2][j - 2] + 1)
                rows[i].append(best)
        return rows[-1][-1]

    terms = ["idiot", "stupid", "moron", "scum", "disgusting", "ass"]
    automaton = toxicity.Automaton([(t, False, 1.0) for t in terms])
    found = "ldiot ztupid xmoron tupid scun skum scuum cusm dsigustnig isgustin sutpid".split()
    assert [w for w in found if not automaton.match(w)] == ["cusm"]
    assert automaton.match("scun") == (toxicity.SHORT, 4) and automaton.match("idito") == (1.0, 1)
    rng = np.random.default_rng(6)
    for term in terms * 200:
        letters = list(term)
        for _ in range(rng.integers(0, 4)):
            at, kind = rng.integers(0, max(len(letters), 1)), rng.integers(0, 4)
            if kind == 0:
                letters[at : at + 1] = "abcdistu"[rng.integers(0, 8)]
            elif kind == 1:
                del letters[at : at + 1]
            elif kind == 2:
                letters[at : at + 2] = letters[at : at + 2][::-1]
            else:
                letters.insert(at, "abcdistu"[rng.integers(0, 8)])
        word = "".join(letters)
        near = any(distance(word, t) <= toxicity.allowed(t) for t in terms)
        assert bool(automaton.match(word)) == near, word
        if word:  # the same by way of the hashes of shortened words
            automaton.words.pop(word, None)
            automaton.meet({word, "another", "ö☃𝄞", "x" * 40})
            assert bool(automaton.words[word]) == near and not automaton.words["another"]


def test_stems_and_quotes():
    automaton = toxicity.Automaton([("idiot", False, 5.0), ("achlich", True, 3.0)])
    assert automaton.match("achlichung") == (3.0, 3)
    assert automaton.match("achlic") is None
    texts = ["you are an idiot", 'he shouted "idiot" at noon', "the paper said idiot once"]
    abuse, quoted, reported = toxicity.features_of(texts, automaton)
    assert abuse[1] > quoted[1] == reported[1]


def test_toxicity_learns_and_catches_planted(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        words = list(rng.choice(base, 40))
        toxic = i % 5 == 0
        if toxic:
            for at in rng.integers(0, 40, 3):
                words[at] = ["stupid", "moronic", "disgusting"][rng.integers(0, 3)]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows.append((1000, " ".join(["you", "stupjd", "moronic", "man", *base[:30]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, marks).collect()}
    assert len(got) == 401
    assert all(got[i].predicted == int(i % 5 == 0) for i in range(400))
    assert got[1000].predicted == 1
    assert toxicity.accepted(docs, marks).count() == 320


def test_toxicity_of_odd_rows(spark, odd, none, clashing):
    marks = spark.createDataFrame(
        [(1, 1, 0), (2, 1, None), (None, 1, 1), (8, 0, 1), (8, 0, 1)], "doc_id long, quality int, toxic int"
    )
    for docs in (odd, clashing):
        assert toxicity.toxicity(docs, marks).count() == odd.count()
        assert toxicity.accepted(docs, marks).columns == docs.columns
    empty = marks.filter("false")
    assert {r.score < 0.5 for r in toxicity.toxicity(odd, empty).collect()} == {True}
    assert toxicity.toxicity(none, marks).count() == 0


def test_language_model_counts_and_normalisation(odd, none, clashing):
    rows = [(r.doc_id, (r.text or "").encode()) for r in odd.collect()]
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows}
    counts, ends = Counter(), 0
    for i, text in rows:
        if not held[i]:
            counts.update(text.lower().split())
            ends += 1
    total, size = sum(counts.values()) + ends, len(counts) + 1
    want = []
    for i, text in rows:
        words = text.lower().split()
        logs = [math.log10((counts[w] + 1) / (total + size + 1)) for w in words]
        base = sum(logs) + math.log10((ends + 1) / (total + size + 1))
        want.append((str(i), held[i], len(words) + 1, sum(w in counts for w in words) + 1, total, round(base, 4)))
    for docs in (odd, clashing):
        got = maxent.scores(docs).collect()
        assert sorted(
            (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got
        ) == sorted(want)
        assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert maxent.scores(none).count() == 0


def test_shares_of_a_class_sum_to_one(spark):
    words = [("the", 50), ("of", 30), *[(f"w{i}ab", 1 + i % 3) for i in range(40)], ("xab", 1)]
    table = spark.createDataFrame([(w.encode(), c) for w, c in words], "word binary, c long")
    before = maxent.SINGLES
    try:
        maxent.SINGLES = 2
        vocab = maxent.vocabulary(table, 7)
    finally:
        maxent.SINGLES = before
    kind = vocab.tail_class(b"w1ab")
    own = np.array([c for w, c in words[2:]])
    shares = 10 ** vocab.share_logs(own, np.full(len(own), kind))
    unseen = 10 ** vocab.share_logs(np.zeros(1), np.array([kind]))
    assert math.isclose(shares.sum() + unseen[0], 1, rel_tol=1e-9)
    weights, rows = maxent.first_weights(vocab), np.zeros((maxent.CLASSES, maxent.FEATURES), np.uint16)
    rows[:, 0] = maxent.CONSTANT
    logs = maxent.log_probabilities(weights, rows, np.arange(maxent.CLASSES))
    assert math.isclose(np.exp(logs).sum(), 1, abs_tol=1e-5)


def test_language_model_follows_the_vocabulary():
    assert maxent.CLASSES >= 128
    none = np.zeros(maxent.CLASSES)

    def rows(distinct):
        vocab = maxent.Vocabulary(9, distinct, {}, none[:0], {}, none, none, none)
        buckets = np.arange(200_000, dtype=np.int64)
        found = maxent.features(buckets % 9, buckets, np.array([len(buckets)]), vocab.bits)
        assert found.max() < len(maxent.first_weights(vocab))
        return len(np.unique(found[:, 2]))

    # a row for 64 words, in powers of two from 2 ** 13 to 2 ** 16
    assert maxent.WORDS_A_ROW == 64
    for distinct, bits in [(100, 13), (500_000, 13), (600_000, 14), (2_000_000, 15), (10**8, 16)]:
        assert maxent.Vocabulary(9, distinct, {}, none[:0], {}, none, none, none).bits == bits
    assert rows(100) <= 1 << 13 < rows(600_000) <= 1 << 14 < rows(2_000_000)


def small_vocabulary():
    endings = {b"ab": 1 + maxent.SINGLES, b"c": 2 + maxent.SINGLES}
    hot = [*(f"h{n}".encode() for n in range(maxent.SINGLES)), b"xab", b"c"]
    counts = np.arange(len(hot), 0, -1)
    some = np.arange(maxent.CLASSES, dtype=float) % 9 + 1
    return maxent.Vocabulary(999, 99, hot, counts, endings, some, some, some * 0)


def test_classes_go_by_groups_with_the_gradient_of_all_their_logits():
    vocab, rng = small_vocabulary(), np.random.default_rng(5)
    assert sorted(vocab.slots) == list(range(maxent.CLASSES))
    rows = rng.integers(0, 40, (50, maxent.FEATURES)).astype(np.uint16)
    rows[:, 0] = maxent.CONSTANT
    rows[:, 5] += 100 * rng.integers(1, 9, 50).astype(np.uint16)
    slots = rng.integers(0, maxent.CLASSES // 2, 50)  # the other groups are never met
    weights = maxent.first_weights(vocab) + rng.normal(0, 1, (1 << vocab.bits, maxent.WIDTH)).astype(np.float32)
    want, squares, met = weights.astype(float), np.zeros(weights.shape), np.zeros(len(weights))

    def softmaxes(row, slot):
        """Columns and probabilities of the groups, and of the members of the slot's group."""
        logits = want[row].sum(0)
        low = maxent.GROUPS + slot // maxent.MEMBERS * maxent.MEMBERS
        for part, own in (((0, maxent.GROUPS), slot // maxent.MEMBERS), ((low, low + maxent.MEMBERS), slot % maxent.MEMBERS)):
            exps = np.exp(logits[slice(*part)])
            yield slice(*part), own, exps / exps.sum()

    found = maxent.log_probabilities(weights, rows, slots)
    brute = [sum(np.log(p[own]) for _, own, p in softmaxes(r, s)) for r, s in zip(rows, slots, strict=True)]
    assert np.allclose(found, brute, atol=1e-4)
    every = maxent.log_probabilities(weights, np.repeat(rows[:1], maxent.CLASSES, 0), np.arange(maxent.CLASSES))
    assert math.isclose(np.exp(every).sum(), 1, abs_tol=1e-4)

    errors = np.zeros((len(rows), maxent.WIDTH))
    for error, row, slot in zip(errors, rows, slots, strict=True):
        for part, own, p in softmaxes(row, slot):
            error[part] = p
            error[part.start + own] -= 1
    for n in range(maxent.FEATURES):
        for row in np.unique(rows[:, n]):
            own = rows[:, n] == row
            sums = errors[own].sum(0)
            squares[row] += sums**2
            want[row] -= maxent.RATE * sums / np.sqrt(squares[row] + 1e-6)
            met[row] += own.sum()
    tokens = maxent.Tokens(np.array([50]), slots, slots, slots, rows, None, slots, slots)
    before, count = weights.copy(), np.zeros(len(weights))
    maxent.gradient_steps(weights, np.zeros_like(weights), count, tokens)
    assert np.allclose(weights, want, atol=2e-3) and (count == met).all()
    unmet = maxent.GROUPS + maxent.CLASSES // 2
    assert (weights[:, unmet:] == before[:, unmet:]).all()


def tree_vocabulary():
    """Two classes of words, one with 40 leaves and one with one, after SINGLES frequent words."""
    hot = [*(f"h{n}" for n in range(maxent.SINGLES)), *(f"w{n}ab" for n in range(40)), "xc", "yc", "zab"]
    counts = np.r_[np.arange(maxent.SINGLES, 0, -1) + 900, np.arange(40, 0, -1) * 20, 2, 1, 1]
    endings = {b"ab": 1 + maxent.SINGLES, b"xc": 2 + maxent.SINGLES, b"yc": 2 + maxent.SINGLES}
    tokens, words, cut = np.zeros((3, maxent.CLASSES))
    tokens[: 1 + maxent.SINGLES] = np.r_[50, counts[: maxent.SINGLES]]
    words[: 1 + maxent.SINGLES] = 1
    tokens[1 + maxent.SINGLES : 3 + maxent.SINGLES] = counts[maxent.SINGLES : -3].sum() + 1, 3
    words[1 + maxent.SINGLES : 3 + maxent.SINGLES] = 41, 2
    cut[1 + maxent.SINGLES :] = 0.5
    return maxent.Vocabulary(9999, 99, [w.encode() for w in hot], counts, endings, tokens, words, cut), hot


def test_words_of_a_class_go_by_the_history_and_sum_to_one():
    vocab, hot = tree_vocabulary()
    rng = np.random.default_rng(3)
    weights = rng.normal(0, 1, maxent.first_node_weights().shape).astype(np.float32)
    own = [w for w in hot if w.endswith("ab") and w != "zab"]

    def logs(before, words):
        tokens = maxent.tokens_of(pa.array([f"{before} {w}" for w in words]), vocab)
        return maxent.word_logs(weights, tokens, vocab)[np.cumsum(tokens.lengths) - 2]

    for before in ("h1", "h2", "w3ab", "unseen"):
        # the words without a leaf, seen once or never, have one leaf together
        found = logs(before, [*own, "zab"])
        assert math.isclose(np.exp(found).sum(), 1, abs_tol=1e-4)
        assert math.isclose(logs(before, ["newab"])[0], found[-1], abs_tol=1e-4)
        assert (logs(before, ["h3"]) == 0).all()
    assert not np.allclose(logs("h1", own), logs("h2", own), atol=0.01)
    kind = vocab.tail_class(b"zab")
    rare = 10 ** vocab.share_logs(np.array([1, 0]), np.array([kind, kind]), rare=True)
    assert math.isclose(rare.sum(), 1)
    # without features met, a word has its share of the class by counts
    start = maxent.first_node_weights()
    tokens = maxent.tokens_of(pa.array(["w0ab w39ab"]), vocab)
    shares = vocab.share_logs(np.array([800, 20]), np.array([kind, kind])) * math.log(10)
    assert np.allclose(maxent.word_logs(start, tokens, vocab)[:2], shares, atol=1e-4)


def test_nodes_are_trained_by_the_gradient_of_their_children():
    vocab, _ = tree_vocabulary()
    tokens = maxent.tokens_of(pa.array(["h1 w0ab w1ab h2 w30ab yc", "w0ab h1 w0ab unseenab xc"] * 5), vocab)
    rng = np.random.default_rng(4)
    weights = rng.normal(0, 1, maxent.first_node_weights().shape).astype(np.float32)
    _, nodes, rows, children = maxent.visits(tokens, vocab)
    assert len(np.unique(nodes)) > 2 and len(nodes) > 30
    want, sums = weights.astype(float), np.zeros((2, 1 << maxent.NODE_BITS, maxent.FAN))
    want = want.reshape(sums.shape)
    met = np.zeros(sums.shape[:2])
    for node, own, child in zip(nodes, rows.T, children, strict=True):
        p = np.exp(vocab.tree.shares[node] + want[0, own[0]] + want[1, own[1]])
        p /= p.sum()
        p[child] -= 1
        for n, row in enumerate(own):
            sums[n, row] += p
            met[n, row] += 1
    want -= maxent.RATE * sums / np.sqrt(sums**2 + 1e-6)
    count = np.zeros(len(weights))
    maxent.node_steps(weights, np.zeros_like(weights), count, tokens, vocab)
    assert np.allclose(weights, want.reshape(weights.shape), atol=2e-3) and (count == met.ravel()).all()


def test_ways_are_shorter_for_frequent_words():
    shares = np.sort(1 / np.arange(1, 2001))
    tree = maxent.Tree.of(np.r_[np.zeros(2000), 1, 2, 2].astype(int), np.r_[shares, 1, 0.5, 0.5])
    assert tree.depth[1999] == 1 and tree.depth[2000] == 0 and tree.depth[2001:].tolist() == [1, 1]
    assert (np.diff(tree.depth[:2000]) <= 0).all() and tree.depth.max() <= 5
    used = tree.shares > -100
    assert math.isclose(np.exp(tree.shares[used]).sum(), len(tree.shares), rel_tol=1e-5)
    ways = {tuple(zip(tree.nodes[:d, i], tree.children[:d, i])) for i, d in enumerate(tree.depth[:2000])}
    assert len(ways) == 2000


def test_hot_words_are_found_by_their_bytes():
    vocab, hot = tree_vocabulary()
    words = pa.array([b"zab", b"h0", b"none", b"h0x", b"w39ab"], pa.large_binary())
    want = [hot.index("zab"), 0, -1, -1, hot.index("w39ab")]
    assert vocab.numbers(words).tolist() == want
    vocab.hot_hashes = np.zeros_like(vocab.hot_hashes)  # two hot words with the same hash
    assert vocab.numbers(words).tolist() == want


def test_score_knows_which_word_of_a_class_follows(spark):
    rng = np.random.default_rng(8)
    filler = [f"f{n}" for n in range(70)]
    rows = []
    for i in range(300):
        words = rng.choice(filler, 30).tolist()
        for at in rng.integers(0, 30, 4):
            words[at] += " before kab" if rng.integers(2) else " after mab"
        rows.append((i, " ".join(words)))
    pairs = ["before kab", "before mab", "after mab", "after kab"]
    rows += [(1000 + i, f"f1 {p} f2") for i, p in enumerate(pairs)]
    found = maxent.scores(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id >= 1000")
    score = {r.doc_id - 1000: r.score for r in found.collect()}
    assert score[0] - score[1] > 0.3 and score[2] - score[3] > 0.3


def test_tokens_of_odd_texts():
    vocab = small_vocabulary()
    texts = ["H0 xAB\x0bc\tq", "", " \r\n", "zzab\x00 \x85h1", "É é zzab"]
    got = maxent.tokens_of(pa.array(texts), vocab)
    hot = [*(f"h{n}".encode() for n in range(maxent.SINGLES)), b"xab", b"c"]
    split = [t.encode().lower().split() for t in texts]
    assert got.lengths.tolist() == [len(w) + 1 for w in split]
    assert got.hot.tolist() == [n for w in split for n in [*(hot.index(x) if x in hot else -1 for x in w), -1]]
    classes = {x: n + 1 for n, x in enumerate(hot[: maxent.SINGLES])}
    assert got.classes.tolist() == [n for w in split for n in [*(classes.get(x, vocab.tail_class(x)) for x in w), 0]]
    rare = [[x for x in w if x not in hot] for w in split]
    assert got.tails.to_pylist() == sum(rare, []) and got.tail_lengths.tolist() == [len(r) for r in rare]
    assert got.tail_classes.tolist() == [vocab.tail_class(x) for x in sum(rare, [])]


def test_code_points_above_the_table_are_letters_only_by_category(spark):
    texts = [EN] * 10 + ["\U000F0000" * 3 + "123", "\U000E0041 \U0010FFFD", "\U00020000\U0002A6D6"]
    docs = many(spark, texts, ["en"] * len(texts))
    rows = {r.doc_id: r for r in langid.identified(docs).collect()}
    assert [rows[i].lang_pred for i in (10, 11)] == ["und", "und"] and rows[10].score == 0
    assert rows[12].lang_pred == "en"


def test_held_out_floors(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    found = langid.identified(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, total = found.filter("lang IS NOT NULL").selectExpr("count_if(lang = lang_pred)", "count(*)").first()
    assert total > 200 and right >= 0.97 * total
    scores = toxicity.toxicity(docs, labels).filter("held_out").join(labels, "doc_id")
    counts = {(r.toxic, r.predicted): r["count"] for r in scores.groupBy("toxic", "predicted").count().collect()}
    clean, toxic = (sum(counts.get((t, p), 0) for p in (0, 1)) for t in (0, 1))
    assert counts[0, 0] >= 0.95 * clean and counts[1, 1] >= 0.6 * toxic


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><a href="/">Home</a><a href="/a">About us and more</a></nav>
<div class="wrap"><div class="post"><h2>Title &amp; more</h2>
<p>First paragraph of the article, long enough to be <b>dense</b> text.
<p>Second   paragraph with <a href="x">one link</a> and
many more words that follow it.</p><form>Name <input></form><script>if (a<b) {"</p>"}</script>
<div class="share">Share this</div></div>
<div class="sidebar"><p>Side text that is also fairly long, with many words</p></div>
<div id="comments"><p>I liked this article very much, thank you for the long text</p></div></div>
<div class="cookie-notice">We use cookies and so on, please accept them all</div>
<footer>Foot &copy;</footer></body></html>"""


def test_article_without_surroundings():
    assert htmltext.main_text(PAGE).split("\n") == [
        "Title & more",
        "First paragraph of the article, long enough to be dense text.",
        "Second paragraph with one link and many more words that follow it.",
    ]


def test_names_around_the_article_keep_it():
    text = "A long sentence of the page, with many words in it and no link at all."
    inner = f"<article><h1>Title</h1><p>{text}</p><p>{text}</p></article>"
    sides = '<div class="site-footer">Foot</div><div class="sidebar"><p>Side</p></div>'
    for name in ("layout has-sidebar", "page-header-fixed", "no-ads", "post share-enabled", "related-work", "search"):
        for tag in ("div", "form"):
            page = f'<body><{tag} class="{name}">{inner}</{tag}>{sides}</body>'
            if name == "search":
                page = f'<body><{tag} class="{name}">{inner}</{tag}></body>'
            assert htmltext.main_text(page) == f"Title\n{text}\n{text}", page
    page = f'<body><div id="search-results">{inner.replace("article", "div")}</div>{sides}</body>'
    assert htmltext.main_text(page) == f"Title\n{text}\n{text}"


def test_article_is_kept_whole():
    page = "<body><nav>x</nav><article><h1>A&lt;b</h1><p>One.<br>Two &amp three<ul><li>x<li>y</ul></article>"
    assert htmltext.main_text(page) == "A<b\nOne.\nTwo & three\nx\ny"
    nested = "<article><section><p>" + "a b c. " * 30 + "</p></section><section><p>Last.</p></section></article>"
    assert htmltext.main_text(nested).endswith("Last.")


LONG = "A long sentence of the page, with many words in it and no link at all. " * 3


@pytest.mark.parametrize("name", ["search", "related", "promo", "alert", "sidebar"])
def test_named_wrapper_of_the_only_article_stays(name):
    article = f"<article><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></article>"
    want = "\n".join(["Title", LONG.strip(), LONG.strip()])
    for after in ("<p>Contact us</p>", "<div><p>Contact us</p><p>Or come by</p></div>"):
        assert htmltext.main_text(f'<body><div class="{name}">{article}</div>{after}</body>') == want
    side = f'<div class="{name}"><article><p>{LONG * 9}</p></article></div>'
    assert htmltext.main_text(f"<body>{article}{side}</body>") == want


def test_lists_of_links_in_an_article_go():
    links = "".join(f'<li><a href="/{n}">Another page {n}</a></li>' for n in range(6))
    body = f'<h1>Title</h1><p>{LONG}</p><p>{LONG} <a href="x">one</a> <a href="y">two</a></p>'
    kept = "<ul><li>One step with words</li><li>Another step</li></ul>"
    for tag in ("article", "main"):
        text = htmltext.main_text(f"<body><{tag}>{body}{kept}<ul>{links}</ul></{tag}></body>")
        assert text.endswith("One step with words\nAnother step") and "one two" in text


def test_reader_comments_and_controls_go():
    remark = "<p>I liked this article very much, thank you for the long text</p>" * 4
    for name in ("comment-list", "post-comments", "reply", "comments"):
        page = f'<body><article><p>Short.</p><div class="{name}">{remark}</div></article></body>'
        assert htmltext.main_text(page) == "Short."
    page = f'<body><div class="no-comments"><h2>Title</h2><p>{LONG}</p></div></body>'
    assert htmltext.main_text(page) == f"Title\n{LONG.strip()}"
    page = "<article><p>Text here.</p><label>Name</label> <output>7</output><legend>Field</legend></article>"
    assert htmltext.main_text(page) == "Text here."


def test_references_are_decoded_within_a_run_of_text():
    assert htmltext.main_text("<p>a &am<b>p;</b> &amp;amp; &lt;b&gt;</p>") == "a &amp; &amp; <b>"


def test_headers_in_deep_articles():
    deep = "<div>" * 1500 + "deep" + "</div>" * 1500
    assert htmltext.main_text(f"<article><header>Top{deep}</header><p>Text.</p></article>") == "Text."
    page = f"<article><header><h1>Top</h1>{deep}</header><p>Text.</p></article>"
    assert htmltext.main_text(page) == "Top\ndeep\nText."


def test_broken_pages_are_read():
    assert htmltext.main_text("") == ""
    assert htmltext.main_text("plain &lt; text") == "plain < text"
    assert htmltext.main_text("<p>a<b>c<!-- never closed") == "ac"
    assert htmltext.main_text("<p title='x>y'>a</div></p>b") == "a\nb"
    assert htmltext.main_text("<script>x") == ""
    assert htmltext.main_text("<" * 2000 + '<a href="' * 500).count("x") == 0
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert htmltext.main_text(deep) == "deep"


def test_page_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", PAGE), (2, "u", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = htmltext.extracted(pages).collect()
    assert sorted(r.n_chars for r in got)[:2] == [0, 0]
    assert len(got) == 4 and all(len(r.text) == r.n_chars for r in got)
    assert htmltext.extracted(pages.filter("false")).count() == 0
    clashing = pages.selectExpr("*", "'x' AS text", "1 AS n_chars")
    assert sorted(r.text for r in htmltext.extracted(clashing).collect()) == sorted(r.text for r in got)
