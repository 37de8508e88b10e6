import collections
import random
import re

import numpy as np

from datasheaf.llm import quality_rules


def plain(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines, repeated = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), repeated, len(covered)


def compare(docs):
    wanted = sorted(str((r.doc_id, *plain(r.text))) for r in docs.select("doc_id", "text").collect())
    judged = quality_rules.judge_quality(docs).collect()
    assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in judged) == wanted
    for r in judged:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and 0 <= r.quality_prob <= 1
        assert not (r.kept and r.base_failed)
    return judged


def test_documents(documents):
    compare(documents)


def test_edges(edges, nothing, spark):
    compare(edges)
    assert compare(nothing) == []
    repeats = ["a b c a b c", "a b c x a b c b c a b", "x x x x", "x x x", "a b\nx\nx\n \n \nx", "a b c d a b e a b c"]
    compare(spark.createDataFrame(list(enumerate(repeats)), "doc_id bigint, text string"))
    kept = quality_rules.good_documents(edges, min_probability=0.0)
    assert kept.columns == edges.columns and [r.doc_id for r in kept.collect()] == [7]


def test_labels(spark, data, documents):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    judged = [r for r in quality_rules.judge_quality(documents).collect() if r.doc_id in labels and not r.base_failed]
    assert all(r.kept for r in judged if labels[r.doc_id] == 1)
    poor = [r for r in judged if labels[r.doc_id] == 0]
    assert poor and sum(not r.kept for r in poor) >= 0.9 * len(poor)


def plain_em(rows, rounds=200):
    """EM document by document over an array of votes; the same model, nothing counted together."""
    v = np.array(rows)
    cast = v != 0
    p = (1 + (v == 1).sum(axis=1)) / (2 + cast.sum(axis=1))
    for _ in range(rounds):
        prior = (1 + p.sum()) / (2 + len(p))
        total = np.full(len(p), np.log(prior / (1 - prior)))
        for j in range(v.shape[1]):
            good_yes, good_no = 1 + p[v[:, j] == 1].sum(), 1 + p[v[:, j] == -1].sum()
            bad_yes, bad_no = 1 + (1 - p)[v[:, j] == 1].sum(), 1 + (1 - p)[v[:, j] == -1].sum()
            hit, miss = good_yes / (good_yes + good_no), bad_yes / (bad_yes + bad_no)
            total += np.where(v[:, j] == 1, max(0, np.log(hit / miss)), np.where(v[:, j] == -1, min(0, np.log((1 - hit) / (1 - miss))), 0))
        p = 1 / (1 + np.exp(-total))
    return p


def test_probabilities_are_those_of_em(documents):
    judged = quality_rules.judge_quality(documents).collect()
    names = [c for c in judged[0].asDict() if c.startswith("vote_")]
    wanted = plain_em([[r[c] for c in names] for r in judged])
    for r, p in zip(judged, wanted, strict=True):
        assert abs(r.quality_prob - p) < 1e-6
        assert r.kept == (not r.base_failed and r.quality_prob >= 0.5)


def test_figures_of_words(spark):
    text = "The cat, and | a d$g || THE end. ## x. No!"
    row = quality_rules.judge_quality(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (row.n_function_words, row.n_bare_words, row.n_symbol_words, row.n_ended_words) == (4, 3, 4, 4)


def test_long_words_are_linear(spark):
    rows = [(1, "a" * 1_000_000), (2, "#" * 1_000_000), (3, "the" * 300_000 + "."), (4, "." * 1_000_000)]
    assert quality_rules.judge_quality(spark.createDataFrame(rows, "doc_id bigint, text string")).count() == 4


def test_one_bad_vote_is_outvoted(spark):
    """Text of capitals only is kept if all else speaks for it; one good vote doesn't save what several rules reject; no vote at all follows the others."""
    rng = random.Random(3)
    good = [" ".join(rng.choice(["the", "and", "river", "stone,", "walks", "slowly.", "of", "bright"]) + rng.choice(["", "s"]) for _ in range(150)) for _ in range(300)]
    junk = [" ".join("".join(rng.choice("abcdefgh") for _ in range(9)) + "$$$" for _ in range(150)) for _ in range(60)]
    odd = [g.upper() for g in good[:5]]
    rows = list(enumerate([*good, *junk, *odd]))
    judged = {r.doc_id: r for r in quality_rules.judge_quality(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(judged[i].kept for i in range(300)) and not any(judged[i].kept for i in range(300, 360))
    for i in range(360, 365):
        votes = [v for c, v in judged[i].asDict().items() if c.startswith("vote_")]
        assert judged[i].kept and votes.count(-1) == 1
    assert any(v == 1 for c, v in judged[300].asDict().items() if c.startswith("vote_"))


def test_few_good_votes_may_not_suffice():
    """In a corpus of junk a document that no rule calls bad is dropped, if the rule that likes it likes all."""
    counts = [((-1, -1, 1), 900), ((1, 1, 1), 100), ((0, 0, 1), 5)]
    model = quality_rules.fit_votes(counts, ["a", "b", "c"])
    assert model.share < 0.2 and abs(model.odds["c"][1]) < 0.1 and model.odds["a"][1] > 2


def test_em_weighs_rules_by_agreement():
    # a and b mostly agree, c votes at random
    counts = [((1, 1, 0), 800), ((-1, -1, 0), 100), ((1, 1, -1), 60), ((-1, -1, -1), 8), ((1, 1, 1), 60), ((-1, -1, 1), 8)]
    model = quality_rules.fit_votes(counts, ["a", "b", "c"])
    assert model.odds["a"][-1] < model.odds["c"][-1] <= 0 and 0.5 < model.share < 1
    assert all(abs(x) < 1e-9 for v in quality_rules.fit_votes([], ["a"]).odds.values() for x in v.values())
