"""Source divergence, prefix trie and chosen-path near-dedup against brute force, on corner cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewell.llm import chosen_path, divergence, trie

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_audit(rows, least, top):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in rows]
    df, tf, of_lang, groups = Counter(), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, words in docs:
        groups[lang].add(source)
        df.update((lang, w) for w in set(words))
    for lang, source, words in docs:
        kept = [w for w in words if df[lang, w] >= least]
        tf[lang, source].update(kept)
        of_lang[lang].update(kept)
    out = set()
    for lang, sources in groups.items():
        terms = sorted(of_lang[lang])
        p = lambda c, v=len(terms): {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * v) for t in terms}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        q, shares = p(of_lang[lang]), {s: p(tf[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(f(shares[s][t], shares[o][t]) for t in terms)) for o in sources if o != s]
            words = [(t, f(shares[s][t], q[t])) for t in terms if tf[lang, s][t] and shares[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", words, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, k) for k, (i, v) in enumerate(items[:most], 1)}
    return out


def test_divergence_against_brute_force(spark):
    r = random.Random(5)
    words = ["a", "The", "Straße", "été", "x-y", "ZZ", "1one2", "\x00nul", "中文", "b" * 300]
    rows = [(" ".join(r.choices(words, range(10, 0, -1), k=r.randint(0, 40))), r.choice(["en", "de", None, ""]), r.choice(["s1", "s2", "S3", None, "é"])) for _ in range(150)]
    rows += [(None, "en", "only-null"), ("", "solo", "one"), ("rare words here", "few", "u"), ("rare words here", "few", "v"), ("a " * 50_000, "en", "s1")]
    rows += [rows[0]] * 20
    df = spark.createDataFrame([(*x, 1, 2, "t") for x in rows], "text string, lang string, source string, tf int, p int, term string")
    got = {tuple(x) for x in divergence.audit(df, least_docs=3, top=4).select("lang", "source", "part", "item", "value", "rank").collect()}
    assert got == brute_audit(rows, 3, 4)
    assert ("few", "u", "pair", "v", 0, 1) in got and not [x for x in got if x[0] == "solo"]


def test_divergence_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


# ---- trie

SYMBOLS = [bytes([i]) * trie.HASH + (i * 10).to_bytes(4) for i in range(3)]


def brute_trie(seqs):
    """{(conv_id, depth): (parent, n_convs, n_children, n_leaves, saved, sha)} of {conv_id: tuple of symbols}."""
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    out = {}
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        kids = {x for x in below if len(x) == len(node) + 1}
        leaves = [x for x in below if not any(y[:-1] == x and y for y in below)]
        saved = sum((len(members[x]) - 1) * int.from_bytes(x[-1][trie.HASH :]) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in own if len(seqs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out[min(own), len(node)] = (parent, len(own), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def sequences_of(r, n):
    return {i: tuple(r.choice(SYMBOLS) for _ in range(r.randint(0, 6))) for i in r.sample(range(-50, 200), n)}


def test_lcp_and_loser_tree():
    r = random.Random(1)
    for _ in range(400):
        rows = [(b"".join(s), i) for i, s in sequences_of(r, r.randint(0, 30)).items()]
        a, b = (r.choice(rows)[0], r.choice(rows)[0]) if rows else (b"", b"")
        want = next((k for k in range(10) if a[k * 20 : k * 20 + 20] != b[k * 20 : k * 20 + 20] or k * 20 >= min(len(a), len(b))), 0)
        assert trie.lcp(a, b) == want
        k = r.randint(1, 7)
        out = list(trie.merged([trie.Run(*trie.front_coded(sorted(rows[i::k]))) for i in range(k)]))
        assert [x[:2] for x in out] == sorted(rows)
        assert [h for *_, h in out] == [trie.lcp(p, q) for p, q in zip([b"", *(x[0] for x in out)], (x[0] for x in out), strict=False)]


def test_ranges_and_their_edges_make_one_trie():
    r = random.Random(2)
    for _ in range(150):
        seqs = sequences_of(r, r.randint(1, 40))
        rows = sorted((b"".join(s), i) for i, s in seqs.items())
        cuts = sorted(r.sample(range(len(rows) + 1), min(len(rows), r.randint(0, 6))))
        found = [x for k, (i, j) in enumerate(zip([0, *cuts], [*cuts, len(rows)], strict=True)) if i < j for x in trie._of_range(k, trie.merged([trie.Run(*trie.front_coded(rows[i:j]))]))]
        edges = sorted((x for x in found if x[0] == "edge"), key=lambda x: (x[1], x[2], x[6]))
        joint = list(trie._of_edges((x[1], x[3], x[5], *x[6:11], x[12]) for x in edges))
        nodes = [x for x in found + joint if x[0] == "node"]
        called = {(x[1], x[3]): x[5] for x in found + joint if x[0] in ("node", "alias")}
        got = {(x[5], x[6]): (called[x[1], x[4]] if x[4] is not None else None, *x[7:11]) for x in nodes}
        assert len(nodes) == len(got) and got == {k: v[:5] for k, v in brute_trie(seqs).items()}


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[: trie.HASH]
            own[c].append((t is not None, t or 0, digest + len(text.encode()).to_bytes(4)))
    own = {c: [s for *_, s in sorted(x)] for c, x in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(own.get(c - int(abs(c) % 5 * (1 if c > 0 else -1)), [])[:h] + own[c][h:])
    return out


@pytest.mark.parametrize("range_bytes", [trie.RANGE_BYTES, 200])
def test_trie_against_brute_force(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(trie, "RANGE_BYTES", range_bytes)
    r = random.Random(3)
    rows = []
    for c in [*range(-6, 60), *range(1_000, 1_030)]:
        if c % 10 != 3:
            rows += [(c, t if r.random() > 0.1 else None, r.choice(["user", "assistant", None]), r.choice(["", None, "hi", "ünï", "a:b"])) for t in range(r.randint(1, 12))]
    rows += [(5_000, t, "user", f"turn {t}") for t in range(300)] + [(5_001, t, "user", f"turn {t}") for t in range(299)]
    rows += [(7_000 + i, 0, "user", "same") for i in range(200)] + [(None, 1, "user", "x"), rows[0], rows[0], (900, 1, "user", "long " * 50_000)]
    df = spark.createDataFrame([(*x, 1, "x", b"y") for x in rows], "conv_id bigint, turn int, role string, text string, base int, symbol string, seq binary")
    got = {(x.conv_id, x.depth): (x.parent_conv_id, x.n_convs, x.n_children, x.n_leaves, x.saved_tokens, x.ends_sha256) for x in trie.prefix_trie(df).collect()}
    assert got == brute_trie(rebuilt(rows))


def test_blocks_of_one_nodes_ids_are_hashed_in_order(spark, tmp_path):
    ids = list(range(-5, 3 * trie.BLOCK))
    rows = [row for k, part in enumerate((ids[:20_000], ids[20_000:])) for row in trie._of_range(k, ((SYMBOLS[1], i, int(n > 0)) for n, i in enumerate(part)))]
    blocks = [(-1, 7, x[1], x[2], bytes(x[12])) for x in rows if x[0] == "ends"]
    assert len(blocks) > 3
    r = random.Random(1)
    r.shuffle(blocks)
    got = trie._hashed_ends(spark.createDataFrame(blocks, "range int, no bigint, from_range int, side int, bytes binary")).collect()
    assert [x.sha for x in got] == [hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()]


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn int, role string, text string")
    assert trie.prefix_trie(none).collect() == []
    short = next(c for c in range(1, 50) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    one = trie.prefix_trie(spark.createDataFrame([(short, 0, "user", "gone")], none.schema)).collect()
    assert [tuple(x) for x in one] == [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]


# ---- chosen path


def shingles(text, n=5):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def brute_near(rows, num=85):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))
    find = lambda x: x if comp[x] == x else find(comp[x])
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                comp[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    smallest = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return sorted(((d, len(s), smallest[find(i)], d == smallest[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


@pytest.mark.parametrize(("small", "deepest"), [(chosen_path.SMALL, chosen_path.DEEPEST), (1, 2), (0, 0)])
def test_chosen_path_against_brute_force(spark, small, deepest):
    r = random.Random(4)
    base = [f"w{i}" for i in range(90)]
    passage = " ".join(f"p{i}" for i in range(40))
    near = [" ".join(w if r.random() > 0.008 else f"n{r.random()}" for w in base) for _ in range(40)]
    shared = [passage + " " + " ".join(f"u{i}.{k}" for k in range(r.randint(5, 60))) for i in range(40)]
    texts = [None, "", " \t", "One two", "one TWO", *near, *shared, *near[:3], "long " + " ".join(f"l{i}" for i in range(30_000)), "a b c d e f g h i j k", "a b c d e f g h i j k l"]
    rows = [*enumerate(texts), (None, near[0]), (None, "just null id"), (7, near[5]), (3, "one two")]
    df = spark.createDataFrame([(*x, 1, "x", 2) for x in rows], "doc_id bigint, text string, key int, comp string, size int")
    found = chosen_path.smallest_ids(chosen_path.linked(df, small=small, deepest=deepest)).collect()
    got = sorted(((x.doc_id, x.n_shingles, x.component_id, x.doc_id == x.component_id) for x in found), key=str)
    assert got == brute_near(rows)


def test_chosen_path_columns_and_nothing(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, None)], "doc_id bigint, text string")
    assert [tuple(x) for x in chosen_path.near_duplicates(df).orderBy("doc_id").collect()] == [(1, 2, 1, True), (2, 0, 2, True)]
    assert chosen_path.near_duplicates(df.limit(0)).collect() == []


def test_trees_reach_the_recall():
    """Simulated paths of a pair at the bar meet as often as the formula says."""
    r = np.random.default_rng(0)

    def together(levels):
        kids = 1 + (r.random() < 1 / 0.85 - 1)
        return levels == 0 or any(r.random() < 0.85 and together(levels - 1) for _ in range(kids))

    assert abs(np.mean([together(4) for _ in range(20_000)]) - chosen_path.kept_together(0.85, 4)) < 0.015
    n = chosen_path.trees(85, 100)
    assert 1 - (1 - 0.85 * chosen_path.kept_together(0.85, chosen_path.DEEPEST)) ** n >= chosen_path.RECALL


def test_minwise_tokens_agree_as_sets_do():
    r = np.random.default_rng(1)
    agreed, apart = [], []
    for s in (20, 200, 9_000):
        for _ in range(30):
            x = r.integers(1 << 63, size=s, dtype=np.uint64) * np.uint64(2)
            y = np.concatenate([x[: s * 92 // 100], r.integers(1 << 63, size=s - s * 92 // 100, dtype=np.uint64)])
            a, b = chosen_path.minwise(x), chosen_path.minwise(y)
            agreed.append((a == b).mean() - len(np.intersect1d(x, y)) / len(np.union1d(x, y)))
            half = [int(v) for v in (chosen_path.sketch(a) ^ chosen_path.sketch(b)).view(np.uint64)]
            apart.append(sum(1 for v in half for k in range(16) if v >> 4 * k & 15))
    assert abs(np.mean(agreed)) < 0.02 and max(apart) <= chosen_path.most_apart(85, 100)
