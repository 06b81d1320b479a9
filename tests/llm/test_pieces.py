"""Memory of the segment lattices that a worker keeps, on a small made-up vocabulary."""

import numpy as np

from weatherlake.llm import pieces


def _vocabulary():
    plain = [b" ", *[bytes([c]) for c in range(97, 123)], *[bytes([a, b]) for a in range(97, 123) for b in range(97, 123)]]
    names = (*plain, *[bytes([b]) for b in range(256)])
    is_plain = np.arange(len(names)) < len(plain)
    weight = 1.0 / (np.arange(len(names)) + 2.7)
    return pieces.Vocabulary(names, np.log(weight / weight.sum()), np.arange(256, dtype=np.int32) + len(plain), is_plain)


def test_kept_lattices_are_few_and_change_no_sample(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join("".join(map(chr, w)) for w in rng.integers(97, 123, (4000, 9))) for _ in range(12)]

    def samples(size):
        sampler = pieces.Sampler(_vocabulary(), 2, 0)
        out = []
        for a in range(0, len(texts), size):
            data, offsets = sampler.prepared(texts[a:a + size])
            out += sampler.sample(data, offsets, np.arange(a, min(a + size, len(texts))))
        return out, len(sampler.kept[2].end) if sampler.kept else 0

    few, kept = samples(2)
    assert kept <= 1 << 18 and pieces.SLICE <= 1 << 18
    monkeypatch.setattr(pieces, "KEPT_NODES", 3 << 18)
    many, more = samples(6)
    assert more > 1 << 18
    for x, y in zip(few, many, strict=True):
        assert [(s[0].tolist(), *s[1:]) for s in x] == [(s[0].tolist(), *s[1:]) for s in y]


def test_short_pieces_need_no_search(monkeypatch):
    vocabulary = _vocabulary()
    trie = pieces.Trie(vocabulary)
    nodes = trie.follow(np.zeros(256, np.int32), np.arange(256))
    assert np.array_equal(trie.one, nodes)
    a, b = np.divmod(np.arange(1 << 16), 256)
    there = nodes[a] >= 0
    assert np.array_equal(trie.two[there], trie.follow(nodes[a[there]], b[there])) and (trie.two[~there] == -1).all()

    asked = []
    follow = pieces.Trie.follow
    monkeypatch.setattr(pieces.Trie, "follow", lambda self, node, byte: asked.append(len(node)) or follow(self, node, byte))
    text = np.frombuffer(b" abcdefgh", np.uint8)
    lattice = pieces.Lattices(text, np.array([0]), np.array([9]), vocabulary, trie)
    assert sum(asked) < len(text)
    # one edge a byte and one a pair of letters; the shares of a node sum to one
    assert len(lattice.to) == 9 + 7
    for i in range(9):
        assert np.isclose(np.exp(lattice.log_p[lattice.first[i]:lattice.first[i + 1]]).sum(), 1.0)
