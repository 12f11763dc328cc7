import tracemalloc

import numpy as np

from tidewell.llm import chosen_path, pii
from tidewell.llm.jaccard import parities


def test_pii_memory_of_a_long_stretch_among_short_ones():
    """One stretch of 20,000 characters does not make all others as long."""
    r, tagger = np.random.default_rng(3), pii.Tagger()
    sizes = [20_000, *r.integers(1, 9, 1_023).tolist()]
    stretches = [r.normal(0, 2, (n, pii.TAGS)).astype(np.float32) for n in sizes]
    tracemalloc.start()
    found = tagger.paths(stretches, [True] * len(sizes), [True] * len(sizes))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6
    assert all((a == b).all() for a, b in zip(found[:40], (tagger.paths([s], [True], [True])[0] for s in stretches[:40]), strict=True))


def test_pii_portions_hold_all_texts_in_order_and_few_characters():
    sizes = [pii.CHARS + 1, 0, 5, pii.CHARS, 1, *[3] * (2 * pii.ROWS), pii.CHARS // 2, pii.CHARS // 2, 1]
    runs = list(pii.portions(sizes))
    assert [i for a, b in runs for i in range(a, b)] == list(range(len(sizes)))
    assert all(b - a <= pii.ROWS and (b - a == 1 or sum(sizes[a:b]) <= pii.CHARS) for a, b in runs)
    assert list(pii.portions([])) == []


def test_chosen_path_forms_few_pairs_of_texts_that_nearly_link(spark, monkeypatch):
    """Of 100 texts with a similarity of 0.75, 4,950 pairs, hardly one is verified; linked ones among them are found."""
    formed, verified = [], chosen_path._verified
    monkeypatch.setattr(chosen_path, "_verified", lambda pairs, *a: formed.append(pairs.count()) or verified(pairs, *a))
    common = " ".join(f"c{k}" for k in range(110))
    texts = [common + " " + " ".join(f"o{i}.{k}" for k in range(18)) for i in range(100)]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[3] + " more", "more " + texts[8]])), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in chosen_path.near_duplicates(docs).collect()}
    assert got == {**{i: i for i in range(100)}, 100: 3, 101: 8}
    assert sum(formed) < 150


def test_chosen_path_blocks_compare_all_pairs(spark, monkeypatch):
    """Pairs of a node that is cut in blocks are those that sizes and bits allow, of classes of different components."""
    r = np.random.default_rng(4)
    base = np.unique(r.integers(1 << 63, size=200, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[r.random(len(base)) > 0.07], r.integers(1 << 63, size=3, dtype=np.uint64)])) for _ in range(60)]
    bits = [np.concatenate([parities(s), chosen_path.sketch(chosen_path.minwise(s))]).tolist() for s in sets]
    comp = [i % 20 if i < 40 else i for i in range(60)]
    outside = sum(c != 0 for c in comp)
    reps = spark.createDataFrame([(i, bits[i]) for i in range(60)], "id bigint, bits array<bigint>")
    nodes = spark.createDataFrame([(7, i, len(sets[i]), comp[i], 60, 0, outside) for i in range(60)], "key bigint, id bigint, size bigint, comp bigint, n bigint, main bigint, outside bigint")
    monkeypatch.setattr(chosen_path, "BLOCK", 16)
    got = {(x.a, x.b) for x in chosen_path._compared(nodes, reps, 85, 100).collect()}
    apart = lambda x, y: sum(((a ^ b) % (1 << 64)).bit_count() for a, b in zip(x[:8], y[:8], strict=True))
    linked = {(a, b) for a in range(60) for b in range(a + 1, 60) if comp[a] != comp[b] and 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}
    allowed = {(a, b) for a in range(60) for b in range(a + 1, 60) if comp[a] != comp[b] and apart(bits[a], bits[b]) * 185 <= (len(sets[a]) + len(sets[b])) * 15}
    assert linked and linked <= got <= allowed


def test_pii_stretches_without_sign_or_digits_are_not_decoded():
    """What no exact test lets pass is left out before the search; the spans added are the same."""
    tagger = pii.Tagger()
    tagger.fit(pii.labelled_texts(500), steps=150)
    tagger.p["c"][0] -= 2  # it takes words for spans
    plain = ["only words, nothing else here. " * 30, "", "7 of 12 were left"]
    texts = [*plain, *(t for t, _ in pii.labelled_texts(300, seed=12)), "a@b.c", "１２３４５６７８９０ 4 digits"]
    added = lambda found: [pii._added(t, pii.base_spans(t), f, -np.inf) for t, f in zip(texts, found, strict=True)]
    every, tested = tagger.spans(texts), tagger.spans(texts, tested=True)
    assert sum(map(len, added(every))) > 0 and added(tested) == added(every)
    assert any(every[:3]) and not any(tested[:3])
    assert sum(map(len, tested)) < sum(map(len, every))
