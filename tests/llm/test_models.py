import math
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import hmm, language
from millrace.llm.common import table

SF = "/root/testdata/sf0.01"


def test_language_by_words_then_shorter_grams():
    model = language.WordBackoff({"en": Counter({"the": 9, "house": 2}), "de": Counter({"der": 9, "haus": 2, "the": 1})})
    assert model.word("the")[model.languages.index("en")] > model.word("the")[model.languages.index("de")]
    assert "hous" not in model.words and model.word("hous")[1] > model.word("hous")[0]  # by its 5-grams
    assert model.predict(["der", "zz", "", "12 !"])[0][0] == "de"
    assert [p for p in model.predict(["", "12 !", "\n"])] == [("und", 0.0)] * 3
    assert language.WordBackoff({}).predict(["text"]) == [("und", 0.0)]


def backoff(counts, words):
    """Scores by language of each word, from dictionaries of words and n-grams and one word after the other."""
    languages = sorted(counts)
    marked = lambda w, n: f"<{w}>" if n > 1 else w
    grams = lambda w, n: [marked(w, n)[i : i + n] for i in range(len(marked(w, n)) - n + 1)]
    cut = lambda n: [sum((Counter({g: 1}) for w, times in counts[lang].items() for _ in range(times) for g in (grams(w, n) if n else [w])), Counter()) for lang in languages]
    scores = {}
    for n in (0, *language.GRAMS):
        parts = cut(n)
        entries = set().union(*parts)
        scores[n] = {e: [math.log(c[e] + 0.5) - math.log(max(sum(c.values()) + 0.5 * len(entries), 0.5)) for c in parts] for e in entries}
    out = []
    for w in words:
        for n in (0, *language.GRAMS):
            found = [scores[n][g] for g in (grams(w, n) if n else [w]) if g in scores[n]]
            if found:
                out.append([sum(x) / len(found) for x in zip(*found)])
                break
        else:
            out.append([0.0] * len(languages))
    return out


def test_language_scores_against_dictionaries(spark, docs_of, monkeypatch):
    counts = {"aa": Counter({"house": 3, "the": 5, "über": 1, "日本": 2}), "bb": Counter({"haus": 2, "der": 4, "the": 1, "x": 1}), "cc": Counter()}
    words = ["the", "hou", "houses", "derhaus", "日", "本日本", "q", "x", "xx", "ü", "日本語の長い", "𐐷"] + ["thed" * 50]
    monkeypatch.setattr(language, "STRETCH", 7)
    want = backoff(counts, words)
    assert np.allclose(language.WordBackoff(counts).scored(words), want, atol=1e-5)
    rows = [(i, " ".join(w for w, n in counts[lang].items() for _ in range(n)), lang) for i, lang in enumerate(counts)]
    fitted = language.fit(docs_of(rows))  # the same counts, made in tasks
    assert fitted.languages == ["aa", "bb", "cc"] and np.allclose(fitted.scored(words), want, atol=1e-5)
    text = "the houses 12 q. derhaus, xx 日本語!"
    sums = np.sum(backoff(counts, ["the", "houses", "q", "derhaus", "xx", "日本語"]), axis=0)
    shares = np.exp((sums - sums.max()) / math.sqrt(6))
    (lang, score), = fitted.predict([text])
    assert lang == fitted.languages[int(sums.argmax())] and abs(score - shares.max() / shares.sum()) < 1e-4


def test_numbers_and_signs_are_no_letters():
    model = language.WordBackoff({"en": Counter({"the": 9}), "de": Counter({"der": 9})})
    assert model.predict(["²", "½ ①", "Ⅷ", "٣", "__"]) == [("und", 0.0)] * 5
    assert model.predict(["²the½"])[0][0] == "en"


def test_languages_held_out(spark):
    got = language.op8_language_id(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.99 * len(held)


def test_languages_of_odd_rows(docs_of, odd_rows):
    rows = [(i, t, None if i is None else "en" if i % 2 else "de") for i, t in odd_rows]
    docs = docs_of(rows)
    model = language.fit(docs)
    got = language.with_language(docs, model)
    assert got.columns[-2:] == ["_lang_pred", "_score"] and got.columns[:-2] == docs.columns
    for r in got.collect():
        assert (r["_lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    assert language.with_language(docs.limit(0), model).collect() == []
    assert language.fit(docs.limit(0)).languages == []
    assert language.fit(docs_of([(1, "a", "xx"), (2, "", "yy")])).languages == ["xx", "yy"]


def test_recursions_against_plain_sums(monkeypatch):
    rng = np.random.default_rng(1)
    k = hmm.STATES
    model = hmm.Hmm(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(hmm.CLASSES), k).T)
    docs = [np.append(rng.integers(1, 50, n), 0).astype(np.uint16) for n in (0, 3, 7, 1, 12, 5)]

    def plain(d):
        a, alphas = model.start * model.emit[d[0]], []
        for x in [*d[1:], None]:
            alphas.append(a)
            a = a if x is None else (a @ model.step) * model.emit[x]
        betas = [np.ones(k)]
        for x in d[:0:-1]:
            betas.insert(0, model.step @ (model.emit[x] * betas[0]))
        p, emit, step = a.sum(), np.zeros_like(model.emit), np.zeros((k, k))
        for t, x in enumerate(d):
            emit[x] += alphas[t] * betas[t] / p
            if t + 1 < len(d):
                step += np.outer(alphas[t], model.emit[d[t + 1]] * betas[t + 1]) * model.step / p
        return math.log(p), emit, step, alphas[0] * betas[0] / p

    want = [plain(d) for d in docs]
    for held in (1_000_000, 9, 4, 1):  # also where a document is worked on in stretches
        monkeypatch.setattr(hmm, "HELD", held)
        assert np.allclose(hmm.log_likelihood(model, docs), [w[0] for w in want])
        got = hmm.Expected()
        got.add(model, docs)
        assert np.allclose(got.emit, sum(w[1] for w in want)) and np.allclose(got.step, sum(w[2] for w in want)) and np.allclose(got.start, sum(w[3] for w in want))


def test_scores(docs_of, odd_rows):
    rows = odd_rows + [(500 + i, "the quick fox " * (i % 5) + f"word{i}") for i in range(80)]
    tokens = [((i, t or ""), (t or "").encode().lower().split()) for i, t in rows]
    held = {i: i is None or zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter()
    for (i, _), words in tokens:
        if not held[i]:
            counts.update([*words, None])
    n, v = sum(counts.values()), len(counts)
    want = sorted(((i, held[i], len(w) + 1, sum(counts[x] > 0 for x in [*w, None]), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in [*w, None]), 6)) for (i, _), w in tokens), key=str)
    got = hmm.score_documents(docs_of(rows), rounds=2).collect()
    assert sorted(((*r[:5], round(r["base_score"], 6)) for r in got), key=str) == want
    assert all(r["score"] <= 0 for r in got)
    same = {r["score"] for r in got if r["n_tokens"] == 1}
    assert max(same) - min(same) < 1e-9  # null, empty and blank texts are the end only


def test_scores_beat_the_base_on_held_out_documents(spark):
    got = [r for r in hmm.op3_hmm_scoring(spark, SF).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > 0.97 * sum(r["base_score"] for r in got) and sum(r["score"] > r["base_score"] for r in got) > 0.8 * len(got)


@pytest.mark.parametrize("rows", [[], [(None, "a b")], [(1, None)]])
def test_scores_of_next_to_nothing(docs_of, rows):
    assert len(hmm.score_documents(docs_of(rows), rounds=1).collect()) == len(rows)
