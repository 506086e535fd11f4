"""How much work fingerprints take, and that cutting many long parts at once changes nothing."""

from itertools import pairwise

import numpy as np

from tickerloom.llm import fingerprints as prints


def test_versions_far_apart_are_entered_into_few_sketches(monkeypatch):
    rng = np.random.default_rng(5)
    common = rng.integers(1, 1 << 62, 400, dtype=np.uint64)
    old = [np.concatenate([common, rng.integers(1, 1 << 62, n, dtype=np.uint64)]) for n in range(0, 600, 20)]
    new = [np.concatenate([common, rng.integers(1, 1 << 62, n, dtype=np.uint64)]) for n in range(0, 600, 20)]
    entered, peeling = [], []
    add, peel = prints.Sketches.add, prints.Sketches.peel

    def counted(self, owner, keys, sign):
        if not peeling:
            entered.append(len(keys))
        add(self, owner, keys, sign)

    def peeled(self):
        peeling.append(True)
        try:
            return peel(self)
        finally:
            peeling.pop()

    monkeypatch.setattr(prints.Sketches, "add", counted)
    monkeypatch.setattr(prints.Sketches, "peel", peeled)
    found = prints.differences(old, new)
    for a, b, (gone, come) in zip(old, new, found):
        assert set(gone.tolist()) == set(a.tolist()) - set(b.tolist())
        assert set(come.tolist()) == set(b.tolist()) - set(a.tolist())
    assert sum(entered) <= 2.5 * sum(map(len, [*old, *new]))


def test_long_parts_cut_together_are_cut_as_alone():
    rng = np.random.default_rng(6)

    def alone(part, one_in):
        codes = list(map(ord, part))
        mask, ends = (1 << 64) - 1, []
        m1, m2, m3 = map(int, prints._MIX)
        for at in range(len(codes) - 2):
            mixed = ((codes[at] * m1 + codes[at + 1]) * m2 + codes[at + 2]) & mask
            mixed = ((mixed ^ (mixed >> 29)) * m3) & mask
            if (mixed >> 40) % one_in == 0:
                ends.append(at + 3)
        return [part[a:b] for a, b in pairwise([0, *ends, len(part)]) if a < b]

    for lengths in ([400], [65, 70, 900, 64, 3, 66], [1000] * 5):
        text = "\n".join("".join(map(chr, rng.integers(0x4E00, 0x4F00, n))) for n in lengths)
        want = [piece for part in text.split("\n")
                for piece in (alone(part, 16) if len(part) > 64 else [part])]
        assert all(len(piece) <= prints.LONGEST_PART for piece in want)
        assert prints.parts(text) == want
