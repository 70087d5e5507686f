"""Pieces of long words reach their ends, in scoring and as landmarks; shared pivots are counted like sets."""

import numpy as np

from listingguard.llm import pivots, toxicity


def test_pieces_cover_words_to_their_ends():
    lengths = np.array([1, 5, 24, 25, 36, 37, 200])
    starts = np.cumsum(lengths) - lengths
    owner, at, size = toxicity.cut(starts, lengths)
    assert (size <= toxicity.PIECE).all() and (np.diff(owner) >= 0).all()
    for w, (start, length) in enumerate(zip(starts, lengths)):
        covered = {i for a, n in zip(at[owner == w], size[owner == w]) for i in range(a, a + n)}
        assert covered == set(range(start, start + length))


def test_landmark_holds_the_end_of_a_long_word():
    rnd = np.random.default_rng(3)
    clean = ["".join(rnd.choice(list("abcdefghilmnoprstu"), 7)) for _ in range(200)]
    long = ["".join(rnd.choice(list("abcdefghilmnoprstu"), 30)) + "zxkwq" for _ in range(6)]
    words = clean + long
    toxic = np.array([0.0] * len(clean) + [5.0] * len(long))
    machine = toxicity.Machine(words, toxic, 5.0 - toxic)
    texts = ["zxkwq", clean[0]]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    found = machine.texts(data, np.array([0, 5, len(data)]))[:, 0]
    assert found[0] > 0 > found[1]


def test_shared_pivots_are_counted_like_sets():
    rnd = np.random.default_rng(5)
    near = np.array([rnd.choice(30, 6, replace=False) for _ in range(60)], np.int32)
    a, b = np.arange(20), np.arange(20, 60)
    want = {(i, j) for i in range(20) for j in range(40) if len(set(near[a[i]]) & set(near[b[j]])) >= 3}
    got = pivots.shared_pivots(near, 3)(a, b)
    assert set(zip(*(x.tolist() for x in got))) == want
