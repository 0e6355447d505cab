import numpy as np

from cinelake.llm import toxicity
from cinelake.llm.common import WordHashes


def labelled(seed, count=4000):
    """Texts toxic by two words together, or by a third alone; each of the two is toxic no more often than any text."""
    rng = np.random.default_rng(seed)
    texts, labels, kinds = [], [], []
    for _ in range(count):
        one, two = (rng.random(2) < 0.2).tolist()
        vile = not one and not two and rng.random() < 0.25
        words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in rng.integers(0, 600, rng.integers(3, 8))]
        words += ["those"] * one + ["insult"] * two + ["vile"] * vile
        texts.append(" ".join(words).encode())
        labels.append(float((one and two) or vile))
        kinds.append("both" if one and two else "single" if one or two else "vile" if vile else "none")
    return texts, np.array(labels), np.array(kinds)


def test_two_terms_toxic_only_together():
    known = WordHashes()
    texts, labels, _ = labelled(1)
    machine = toxicity.Machine().fit([toxicity.terms_of(t, known) for t in texts], labels)
    texts, labels, kinds = labelled(2)
    rows = [toxicity.terms_of(t, known) for t in texts]
    lengths = np.array([len(r) for r in rows])
    scores = 1 / (1 + np.exp(-machine.margins(np.concatenate(rows), np.cumsum(lengths) - lengths)))
    shares = {kind: float((scores[kinds == kind] >= 0.5).mean()) for kind in ("both", "single", "vile", "none")}
    assert shares["both"] > 0.9 and shares["vile"] > 0.9, shares
    assert shares["single"] < 0.05 and shares["none"] < 0.05, shares
