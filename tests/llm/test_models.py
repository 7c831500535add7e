from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash

from saleswh.llm import lm_scoring, quality, recurrent, url_filter
from saleswh.llm.registry import URL_RULES
from tests.llm.fixtures import documents, odd_rows, words


def _small_model():
    pick = np.random.default_rng(0)
    known = recurrent.Symbols(
        np.array([0] * 4 + [1] * 4 + [2, 3, 4, 5]), np.array([0, 1, 2, 3, 0, 1, 2, 3, -1, -1, -1, -1])
    )
    p = {n: pick.standard_normal(s) * 0.3 for n, s in recurrent.shapes(12, 6, 2, 5).items()}
    p["word_bias"][:, 4:] = -1e4
    return p, known, pick


def test_gradients_equal_differences():
    p, known, pick = _small_model()
    symbols = pick.integers(0, 12, (6, 4))
    real, first = np.ones((6, 4), bool), np.zeros((6, 4), bool)
    real[5, 3], first[0], first[3, 1] = False, True, True
    at = lambda: recurrent.gradients(p, known, np.zeros((4, 5)), symbols, real, first)
    _, gradient, met, _ = at()
    whole = np.zeros_like(p["input"])
    whole[met] = gradient["input"]
    gradient["input"] = whole
    for name, value in p.items():
        flat = value.ravel()
        for i in pick.integers(0, flat.size, 3):
            old = flat[i]
            flat[i] = old + 1e-5
            above = at()[0]
            flat[i] = old - 1e-5
            below = at()[0]
            flat[i] = old
            assert abs((above - below) / 2e-5 - gradient[name].ravel()[i]) < 1e-6


def test_states_go_on_over_windows_and_chances_sum_to_one():
    p, known, pick = _small_model()
    texts = [pick.integers(0, 12, n) for n in (1, 40, 7, 90)]
    edges = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    found = [recurrent.score(p, known, np.concatenate(texts), edges, window=w) for w in (3, 1000)]
    assert np.allclose(found[0], found[1])
    h, total = np.zeros((1, 5)), 0.0
    for symbol in texts[1]:
        every = np.arange(12)
        chance = recurrent.log_likelihood(p, np.repeat(h, 12, 0), known.of_class[every], known.in_class[every])
        assert abs(np.exp(chance).sum() - 1) < 1e-5
        total += chance[symbol]
        h = recurrent.step(p, h, np.array([symbol]))[0]
    assert abs(total - found[0][1]) < 1e-3


def test_base_scores_are_exact_and_the_model_learns(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "FREQUENT_WORDS", 60)
    # Two "languages": a text keeps to one of them.
    rows = odd_rows() + [(i, " ".join(f"{'ab'[i % 2]}{w}" for w in words(i, 60, 40))) for i in range(400)]
    found = lm_scoring.score_documents(documents(spark, rows)).collect()
    tokens = [((t or "").encode().lower().split() + [None]) for _, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    counts = Counter(w for ts, h in zip(tokens, held, strict=True) if not h for w in ts)
    total = sum(counts.values())
    want = sorted(
        (repr(d), h, len(ts), sum(counts[w] > 0 for w in ts), total,
         round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in ts), 5))
        for (d, _), ts, h in zip(rows, tokens, held, strict=True)
    )
    got = sorted(
        (repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found
    )
    assert got == want
    unseen = [r for r in found if r.held_out and r.doc_id < 400]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen) + 0.1 * sum(r.n_tokens for r in unseen)
    assert lm_scoring.score_documents(documents(spark, [])).count() == 0


def test_whole_scores_equal_a_plain_version(spark, monkeypatch):
    """Every token in turn: its class, its word within the class, or a rare word's share of its ending group."""
    n = lm_scoring.SYMBOL_WORDS
    monkeypatch.setattr(lm_scoring, "FREQUENT_WORDS", n + 200)
    rows = odd_rows()[:5] + odd_rows()[6:] + [(i, " ".join(words(i, 300 + i, 7000))) for i in range(60)]
    made = []

    def fixed(training, corpus):
        known = lm_scoring.word_classes(corpus, np.random.default_rng(1).integers(0, 5, (n, lm_scoring.CONTEXTS)))
        share = np.random.default_rng(2).random((n // 64, 64))
        p = recurrent.first_parameters(np.full(n // 64 + lm_scoring.ENDINGS, 0.01), share, n + lm_scoring.ENDINGS)
        p["word_out"] = np.random.default_rng(3).standard_normal(p["word_out"].shape).astype(np.float32)
        made.append((p, known, corpus))
        return p, known

    monkeypatch.setattr(lm_scoring, "train_model", fixed)
    found = lm_scoring.score_documents(documents(spark, rows)).collect()
    p, known, corpus = made[0]
    texts = [(t or "").encode().lower().split() for _, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    counts = Counter(w for ws, h in zip(texts, held, strict=True) if not h for w in [*ws, None])
    rank = {int(w): i for i, w in enumerate(corpus.words[:n])}
    ending = lambda w: zlib.crc32(w[-3:]) % lm_scoring.ENDINGS
    number = lambda w: 0 if w is None else int(np.uint64(xxhash.xxh64_intdigest(w)).view(np.int64))
    tokens, kinds = Counter(), Counter()
    for w, times in counts.items():
        if number(w) not in rank:
            tokens[ending(w)] += times
            kinds[ending(w)] += 1
    want = []
    for (doc_id, _), ws in zip(rows, texts, strict=True):
        h, total = np.zeros((1, recurrent.HIDDEN), np.float32), 0.0
        for w in [*ws, None]:
            symbol = rank.get(number(w), None)
            group = None if symbol is not None else ending(w)
            symbol = n + group if symbol is None else symbol
            scores = (h @ p["class_out"] + p["class_bias"])[0].astype(float)
            c, i = known.of_class[symbol], known.in_class[symbol]
            total += scores[c] - np.log(np.exp(scores).sum())
            if i >= 0:
                scores = (h @ p["word_out"][c] + p["word_bias"][c])[0].astype(float)
                total += scores[i] - np.log(np.exp(scores).sum())
            else:
                total += math.log((counts[w] + 0.1) / (tokens[group] + 0.1 * (kinds[group] + 1)))
            h = recurrent.step(p, h, np.array([symbol]))[0]
        want.append((repr(doc_id), total / math.log(10)))
    got = sorted((repr(r.doc_id), r.score) for r in found)
    assert [a for a, _ in got] == [a for a, _ in sorted(want)]
    assert np.allclose([x for _, x in got], [x for _, x in sorted(want)], rtol=1e-4, atol=1e-3)


def test_means_over_many_workers(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "COPIES_AT_ONCE", 3)
    values = np.random.default_rng(5).random((20, 2, 4)).astype("<f4")
    rows = [(b, w, 1, values[w, b].tobytes()) for w in range(20) for b in range(2)]
    copies = spark.createDataFrame(rows, "block int, worker int, n long, values binary")
    found = lm_scoring._mean_parameters(copies, 20).to_pylist()
    by_block = {r["block"]: np.frombuffer(r["values"], "<f4") for r in found}
    assert all(np.allclose(by_block[b], values[:, b].mean(axis=0), atol=1e-6) for b in range(2)) and len(found) == 2


def test_every_training_document_is_learned_from_once(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "TOKENS_PER_WORKER", 4000)
    # More than 1.5 million training tokens, each text with its own most frequent words.
    rows = [*odd_rows(), *((i, " ".join(words(i, 16000))) for i in range(110))]
    training = documents(spark, rows).select("text")
    corpus = lm_scoring.corpus_of(lm_scoring.count_words(training))
    assert corpus.tokens > 1_700_000
    sent = spark.sparkContext.broadcast(corpus)
    learned = lm_scoring.training_symbols(training, sent).collect()
    assert {r.turn for r in learned} == set(range(lm_scoring.ROUNDS))
    rank = {int(w): i for i, w in enumerate(corpus.words)}
    want = []
    for _, text in rows:
        hashes, _, _ = lm_scoring.tokens_of(pa.array([text], pa.string()))
        want.append([rank[int(w)] for w in hashes])
    frequent = lambda found: [x if x < lm_scoring.SYMBOL_WORDS else -1 for x in found]
    got = sorted(frequent(np.frombuffer(r.symbols, "<u2").tolist()) for r in learned)
    assert got == sorted(map(frequent, want))


def _url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def test_rules_and_ratio_of_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "https://A.Example.ORG/es/1", "http://example.org/en/12?x#y", "x://org/",
        "http://notorg/", "http://a.com/fr/", "http://com/de/9", "http://b.net/zzz", "http://a.org", "a://b://c/d",
    ]
    urls += [f"http://good{i % 7}.com/fr/page{i}" for i in range(60)] + [f"http://spam{i % 7}.com/de/pills{i}" for i in range(60)]
    urls += ["http://good3.net/fr/page77", "http://spam3.net/de/pills88", "http://spam3.net/de/pills88"]
    pages = spark.createDataFrame([(i, u, "h", "g") for i, u in enumerate(urls)], "page_id long, url string, host string, gram string")
    found = {r.page_id: r for r in url_filter.judge_urls(pages, URL_RULES).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        host, path = _url_parts(url)
        fits = [(len(h + p), h + p, a) for a, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits)[1:] if fits else (None, None)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule[0])
        assert rule[1] in (None, found[i].verdict) and found[i].verdict in ("allow", "block")
    assert found[len(urls) - 3].verdict == "allow"
    assert found[len(urls) - 2].verdict == found[len(urls) - 1].verdict == "block"
    # The ratio of one URL, worked out plainly.
    grams = {"allow": Counter(), "block": Counter()}
    for r in found.values():
        if r.rule:
            whole = "\x02" * 4 + urls[r.page_id] + "\x03"
            for at in range(4, len(whole)):
                for k in range(5):
                    grams[r.verdict][whole[at - k : at + 1]] += 1
    contexts = {kind: Counter() for kind in grams}
    for kind, seen in grams.items():
        for gram, n in seen.items():
            contexts[kind][len(gram), gram[:-1]] += n

    def chance(kind, gram):
        p = 1 / 256
        for k in range(5):
            part = gram[4 - k :]
            p = (grams[kind][part] + 2 * p) / (contexts[kind][k + 1, part[:-1]] + 2)
        return p

    whole = "\x02" * 4 + "http://spam3.net/de/pills88" + "\x03"
    ratios = [math.log10(chance("allow", g) / chance("block", g)) for g in (whole[i : i + 5] for i in range(len(whole) - 4))]
    assert abs(found[len(urls) - 1].score - sum(ratios) / len(ratios)) < 1e-6
    assert url_filter.judge_urls(pages.filter("false"), URL_RULES).count() == 0


def test_urls_are_judged_by_query_and_without_scheme_too(spark):
    urls = [f"http://good{i % 7}.com/fr/p?u=library-{i}" for i in range(60)]
    urls += [f"http://spam{i % 7}.com/de/p?u=casino-win-{i}" for i in range(60)]
    urls += ["http://x.net/p?u=library-7", "http://x.net/p?u=casino-win-7", "u=library-8", "u=casino-win-8"]
    rules = [("allow", f"good{i}.com", "") for i in range(7)] + [("block", f"spam{i}.com", "") for i in range(7)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, rules).collect()}
    assert [found[i] for i in range(120, 124)] == ["allow", "block", "allow", "block"]


def _features(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def _quality_rows():
    prose = [(i, "The sun and the moon are of a kind, as is the sea.\n" + " ".join(["the"] + words(i, 60, 10**6)) + ".") for i in range(80)]
    bad = [(500 + i, " | ".join(words(i, 80, 10**6))) for i in range(8)]
    bad += [(600 + i, "buy this thing now ok " * 30) for i in range(8)]
    bad += [(700 + i, " ".join(words(i, 90, 10**6)).upper()) for i in range(8)]
    return prose, odd_rows() + [(900, "same line here\nsame line here\n\n  \nsame line here")] + bad


def test_base_counts_and_verdicts(spark):
    good, other = _quality_rows()
    docs = documents(spark, good + other)
    found = quality.quality_verdicts(docs).collect()
    want = sorted((repr(d), *_features(t)) for d, t in good + other)
    assert sorted((repr(r.doc_id), *(r[c] for c in quality.BASE_COLUMNS)) for r in found) == want
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)
        assert r.doc_id is None or r.kept or r.doc_id >= 80
        assert r.doc_id is None or not 500 <= r.doc_id < 800 or not r.kept
    left = quality.drop_low_quality(docs)
    assert left.schema == docs.schema
    assert sorted(repr(r.doc_id) for r in left.collect()) == sorted(repr(r.doc_id) for r in found if r.kept)
    assert quality.quality_verdicts(documents(spark, [])).count() == 0


def test_expectation_maximisation_equals_a_plain_version(spark):
    good, other = _quality_rows()
    votes = quality.with_votes(documents(spark, good + other))
    model = quality.fit_label_model(votes, rounds=4, prior_documents=40)
    names = list(quality.rules())
    rows = [[r[f"vote_{n}"] for n in names] for r in votes.select(*(f"vote_{n}" for n in names)).collect()]
    start = now = quality.first_model(names)
    for _ in range(4):
        post = []
        for row in rows:
            a, b = now.good, 1 - now.good
            for name, v in zip(names, row, strict=True):
                a, b = a * now.said[name][1][v], b * now.said[name][0][v]
            post.append(a / (a + b))
        own = 40
        weight = {1: sum(post) + own, 0: len(rows) - sum(post) + own}
        said = {
            n: {
                y: {
                    v: (sum((p if y else 1 - p) for p, row in zip(post, rows, strict=True) if row[j] == v) + own * start.said[n][y][v]) / weight[y]
                    for v in (-1, 0, 1)
                }
                for y in (0, 1)
            }
            for j, n in enumerate(names)
        }
        now = quality.LabelModel((sum(post) + own * start.good) / (len(rows) + own), said)
    assert abs(now.good - model.good) < 1e-9
    assert all(abs(now.said[n][y][v] - model.said[n][y][v]) < 1e-9 for n in names for y in (0, 1) for v in (-1, 0, 1))
