"""The forward algorithm of operator 5 sums all segmentations, of long pieces and long words too."""

from __future__ import annotations

import math

import numpy as np

from vitals.llm import langid, queries


def _summed(word, vocab, prob):
    """Log of the sum over all segmentations, one piece after another, in exact integers."""
    text, alpha, bits = langid.START + word, [1 << 400], 400
    for end in range(1, len(text) + 1):
        total = 0
        for at in range(end):
            row = vocab.get(text[at:end], 0 if end - at == 1 else None)
            if row is not None:
                num, den = prob[row].as_integer_ratio()
                total += alpha[at] * num // den
        alpha.append(total)
        if total < 1 << 200:  # keep enough digits
            alpha, bits = [a << 400 for a in alpha], bits + 400
    return math.log(alpha[-1]) - bits * math.log(2)


def test_all_segmentations_are_summed():
    vocab = langid.pieces(queries.piece_vocabulary())
    table = langid.Pieces(vocab)
    assert {"▁professional", "▁international", "▁organization"} <= set(vocab) and table.longest == max(map(len, vocab)) > 12
    prob = np.random.default_rng(3).random((len(vocab) + 1, 2)) ** 4 / 1000 + 1e-9
    long = "internationalorganization" * 3
    words = ["a", "professional", "professionals", long, "日本語" * 40, (long + "ÿ") * 20]
    assert langid.words_of("A " + long.upper()) == ["a", long]
    got = langid.log_probabilities(words, table, langid.padded(prob))
    for word, row in zip(words, got, strict=True):
        for k in range(2):
            assert math.isclose(row[k], _summed(word, vocab, prob[:, k].tolist()), rel_tol=1e-9)


def test_expected_counts_of_long_words(monkeypatch):
    vocab = {p: i + 1 for i, p in enumerate(["▁", "a", "b", "ab", "▁a", "ba", "abababababababab"])}
    table = langid.Pieces(vocab)
    prob = np.array([[0.01], [0.2], [0.1], [0.15], [0.1], [0.2], [0.04], [0.2]])
    words, counts = ["ab" * 30 + "c", "ab", "ba" * 20, "ab" * 30 + "d"], np.array([[2.0], [3.0], [1.0], [1.0]])
    length = np.array([1, *map(len, vocab)])
    padded, totals = langid.padded(prob), []
    for stretch in (langid.STRETCH, 16, 48):
        monkeypatch.setattr(langid, "STRETCH", stretch)
        total = langid.expected(words, counts, table, padded)
        # every segmentation covers all characters, and no count is lost at a stretch's border
        assert math.isclose((total[:-1, 0] * length).sum(), sum((len(w) + 1) * c for w, c in zip(words, counts[:, 0], strict=True)))
        totals.append(total)
    assert np.allclose(totals[0], totals[1]) and np.allclose(totals[0], totals[2])
    # the gradient of the log-probability gives the same counts
    for row in range(len(prob)):
        step = prob.copy()
        step[row] *= 1 + 1e-6
        rise = (counts * (langid.log_probabilities(words, table, langid.padded(step)) - langid.log_probabilities(words, table, padded))).sum() / 1e-6
        assert math.isclose(rise, totals[0][row, 0], rel_tol=1e-4, abs_tol=1e-5)
