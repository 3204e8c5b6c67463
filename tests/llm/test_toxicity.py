import itertools
import math

import numpy as np
import pytest
from tapeline.llm import queries
from tapeline.llm.toxicity import LEET, LETTERS, ORDER, SEPARATORS, LanguageModel, _code, count_grams, log_probabilities, suspicious, toxicity_scores

SF = "/root/testdata/sf0.01"
WORDS = "you are a total idiot and a stupid loser the gate step is done with all evidence in this module run " * 40


@pytest.fixture(scope="module")
def language():
    total = np.zeros(LETTERS**ORDER)
    count_grams(WORDS, total)
    return LanguageModel(log_probabilities(total))


@pytest.mark.parametrize("seen,want", [
    ("1d10t", "idiot"), ("l0ser", "loser"), ("5tup1d", "stupid"), ("i d i o t", "idiot"), ("s.t.u.p.i.d", "stupid"),
    ("stuuuuupid", "stupid"), ("$tup!d", "stupid"), ("L-0-s-3-r", "L-0-s-3-r"), ("l o s e r", "loser"), ("module", "module"),
])
def test_readings(language, seen, want):
    assert language.restore(f"the {seen} run") in (f"the {want} run",) or want == seen


@pytest.mark.parametrize("seen,want", [
    ("sh!+", "shit"), ("a$$", "ass"), ("s 7 u p 1 d", "stupid"), ("i d 1 o t", "idiot"), ("L-0-s-3-r", "Loser"), ("s.t.u.p.1.d", "stupid"),
    ("5 t u p ! d", "stupid"), ("idio+", "idiot"), ("l0s€r", "loser"), ("los€r!", "loser!"), ("naz!", "nazi"), ("naz!!", "nazi!"),
    ("stupid!!", "stupid!!"), ("loser!", "loser!"), ("s t u p 1 d !", "stupid!"), ("1 3 5 7", "1 3 5 7"), ("12!", "12!"),
])
def test_leet_at_the_end_and_between_separators(seen, want):
    total = np.zeros(LETTERS**ORDER)
    count_grams(WORDS + "shit ass nazi " * 40, total)
    assert LanguageModel(log_probabilities(total)).restore(f"the {seen} run") == f"the {want} run"


def test_viterbi_against_all_readings(language):
    """Every path through the lattice, scored one by one."""
    def readings(found):
        low = found.lower()
        for i, c in enumerate(low):
            options = [(ord(x) - 96, x, math.log(0.3)) for x in LEET.get(c, "")]
            options.append((0, found[i], math.log(0.2)) if c in LEET or not c.isalpha() else (_code(c), found[i], 0.0))
            if i and (c == low[i - 1] and c.isalpha() or c in SEPARATORS):
                options.append(None)
            yield options

    for found in ("1d1ot", "sss", "a b c", "l00oo", "g4t3", "aab!"):
        best = -math.inf, ""
        for path in itertools.product(*readings(found)):
            score, history, out = 0.0, [0, 0, 0], ""
            for step in path:
                if step is None:
                    score += math.log(0.5)
                    continue
                to, text, cost = step
                score += cost + float(language.log[((history[0] * 27 + history[1]) * 27 + history[2]) * 27 + to])
                history = [0, 0, 0] if to == 0 else [*history[1:], to]
                out += text
            score += float(language.log[((history[0] * 27 + history[1]) * 27 + history[2]) * 27])
            best = max(best, (score, out))
        assert language.decode(found) == best[1]


def test_suspicious_places():
    places = lambda t: tuple(len(x) for x in suspicious(t))
    assert places("plain words!! 12 of them.") == places("") == places("a b") == (0, 0)
    assert places("1diot") == (1, 0) and places("a i d b") == (0, 2) and places("sooo") == (1, 0)


def test_restore_keeps_the_rest(language):
    text = "A 1d10t,\tsaid: s-t-u-p-i-d!! (l0s3r) E=mc2 é é é x@y.z " + "q" * 500
    got = language.restore(text)
    assert got.startswith("A idiot,\tsaid: stupid!! (loser) ")
    assert language.restore("no change, here") == "no change, here"


def test_held_out_accuracy(spark):
    rows = queries.QUERIES["op9_noisy_channel_toxicity"](spark, SF).collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.9


def test_obfuscated_texts_score_like_plain_ones(spark, frame):
    clean = "the gate step is done with all evidence in this module run number"
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for i in range(600):
        words = rng.permutation(clean.split()).tolist()
        if i % 3 == 0:
            words[4] = ["idiot", "loser", "stupid"][i % 9 // 3]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    probes = {1000: "the 1d10t module", 1001: "the s t u p i d module", 1002: "the looooser module", 1003: "the done module", 1004: None, 1005: ""}
    rows = toxicity_scores(frame(docs + list(probes.items()) + [(None, "x"), (3, docs[3][1])]), spark.createDataFrame(labels + [(None, 1), (9999, 1)], "path long, toxic int"))
    rows = rows.collect()
    assert len(rows) == 608
    score = {r.path: r.score for r in rows}
    assert min(score[1000], score[1001], score[1002]) > 0.9
    assert max(score[1003], score[1004], score[1005]) < 0.1


def test_no_labels_and_no_rows(spark, frame):
    labels = spark.createDataFrame([], "path long, toxic int")
    assert all(abs(r.score - 0.5) < 0.01 for r in toxicity_scores(frame([(1, "x"), (2, None)]), labels).collect())
    assert toxicity_scores(frame([]), labels).collect() == []
