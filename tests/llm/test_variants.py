"""Spelling variants, source divergence and SimHash classes against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from larder.llm import sim_hash, spelling_trie
from larder.llm.components import linked_components
from larder.llm.letter_runs import letter_runs
from larder.llm.sim_hash import near_links, sim_hash_classes
from larder.llm.source_divergence import accumulate, divergence, source_divergence
from larder.llm.spelling_trie import spelling_variants

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def many_ranges(spark):
    """Sorted ranges and key partitions stay apart, as on large tables."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def brute_words(rows, length, least, noise):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            hash_ = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = hash_ % len(run)
            n[run if hash_ % noise else run[:at] + run[at + 1 :]] += 1
    return {w: c for w, c in n.items() if len(w) >= length and c >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, length, least, noise):
    n = brute_words(rows, length, least, noise)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def typed_texts():
    """Texts over few letters, so that words have many neighbours, runs and chains of forms."""
    draw = np.random.default_rng(5)
    words = ["".join(draw.choice(list("abé"), draw.integers(1, 8))) for _ in range(120)]
    weights = 1 / np.arange(1, 121)
    rows = []
    for i in range(60):
        chosen = draw.choice(words, 80, p=weights / weights.sum())
        rows.append((i, " ".join(w.upper() if j % 7 == 0 else w for j, w in enumerate(chosen))))
    return rows


AWKWARD = [
    (None, None),
    (None, "Tokens tokens tokensĀtokens — toXens TOKENS"),
    (7, ""),
    (7, "   \n\t"),
    (8, "中文 \U0001f600 tokns tokns tokns"),
    (8, "中文 \U0001f600 tokns tokns tokns"),
    (9, "z" * 60_000 + " " + "z" * 60_000 + " " + "z" * 60_000),
    (10, "z" * 59_999 + " " + ("z" * 59_999 + " ") * 3),
]


@pytest.mark.parametrize("noise", [1, 2, 97])
def test_variants_are_those_of_brute_force(spark, many_ranges, noise):
    rows = typed_texts()
    docs = spark.createDataFrame([(*r, r[0]) for r in rows], "doc_id long, text string, word long")
    got = {tuple(r) for r in spelling_variants(docs, length=2, least=2, noise=noise).collect()}
    assert got == brute_variants(rows, 2, 2, noise) and len(got) > 30


def test_variants_of_awkward_texts(spark):
    docs = spark.createDataFrame([(*r, 1) for r in AWKWARD], "doc_id long, text string, n long")
    got = {tuple(r) for r in spelling_variants(docs).collect()}
    assert got == brute_variants(AWKWARD, 5, 3, 97)
    assert ("tokns", None, "tokns", 6, 1, None) in got and len(got) >= 4
    assert spelling_variants(docs.limit(0)).count() == 0


def test_equal_prefixes_have_one_number_over_all_ranges(spark, many_ranges):
    draw = np.random.default_rng(1)
    words = sorted({"".join(draw.choice(list("abc"), draw.integers(1, 7))) for _ in range(400)})
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(8)
    rows = spelling_trie.numbered(frame, "word", "path").collect()
    number = {}
    for r in rows:
        assert len(r["path"]) == len(r["word"]) + 1
        for i, node in enumerate(r["path"]):
            assert number.setdefault(r["word"][:i], node) == node
    assert len(set(number.values())) == len(number) and set(number.values()) == set(range(len(number)))
    ends = [number[w] for w in words]
    assert ends == sorted(ends)


def test_runs_are_not_cut_by_pieces():
    text = ("ab-c'" * 50 + "é" * 40 + " 12 x").encode()
    whole = [w for part in letter_runs(text) for w in part]
    assert [w for part in letter_runs(text, 7) for w in part] == whole
    assert whole[:3] == [b"ab", b"c", b"ab"] and whole[-1] == b"x"


def brute_divergence(rows, least, top):
    texts = [[x or "" for x in r] for r in rows]
    docs, n = Counter(), Counter()
    found = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t[0].translate(ASCII_LOWER)) for t in texts]
    for (_, lang, _), terms in zip(texts, found, strict=True):
        docs.update({(lang, t) for t in terms})
    for (_, lang, source), terms in zip(texts, found, strict=True):
        n.update((lang, source, t) for t in terms if docs[lang, t] >= least)
    groups = sorted({(t[1], t[2]) for t in texts})
    kept = defaultdict(list)
    for lang, term in sorted(k for k, c in docs.items() if c >= least):
        kept[lang].append(term)

    def p(lang, sources, term):
        every = kept[lang]
        count = sum(n[lang, s, term] for s in sources)
        total = sum(n[lang, s, t] for s in sources for t in every)
        return 1 + 10**9 * (count + 2) // (total + 2 * len(every))

    out = set()
    for lang, source in groups:
        peers = [s for g, s in groups if g == lang]
        own = {t: p(lang, [source], t) for t in kept[lang]}
        pairs, terms = [], []
        for other in peers:
            if other != source:
                apart = sum((own[t] - q) ** 2 // (own[t] + q) for t in own for q in [p(lang, [other], t)])
                pairs.append((-apart, other.encode()))
        for t in own:
            q = p(lang, peers, t)
            if n[lang, source, t] and own[t] > q:
                terms.append((-((own[t] - q) ** 2 // (own[t] + q)), t.encode()))
        for part, values in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out |= {(lang, source, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(values)}
    return out


def test_divergence_over_many_blocks(spark):
    draw = np.random.default_rng(3)
    words = ["alpha", "Beta", "gämma", "中", "x1y", "Omega"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [
        (" ".join(draw.choice(words, 12)), ["en", "de", None][i % 3], [f"s{i % 5}", None][i % 7 == 0])
        for i in range(90)
    ] + [(None, "en", "empty"), ("solitary", "fr", "only"), ("", "fr", "other"), ("", "", "")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "text string, lang string, source string, n int")
    want = brute_divergence(rows, 3, 4)
    for block in (1 << 17, 7):
        got = {tuple(r) for r in source_divergence(docs, 3, 4, block).collect()}
        assert got == want
    assert ("fr", "only", "pair", "other", 0, 1) in want
    assert source_divergence(docs.limit(0)).count() == 0


def test_rows_of_a_block_in_parts(monkeypatch):
    from larder.llm import source_divergence as module

    draw = np.random.default_rng(2)
    dense = draw.integers(1, 50, (30, 6)) * (draw.random((30, 6)) < 0.5)
    term, group = np.nonzero(dense)
    zero = draw.integers(1, 9, 6)
    monkeypatch.setattr(module, "PRODUCTS", 5)
    rows = np.array(list(accumulate(term, group, dense[term, group], zero)))
    seen = dense[dense.any(axis=1)] if term.max() + 1 < 30 else dense[: term.max() + 1]
    p = np.where(dense > 0, dense, zero)[: term.max() + 1]
    want = divergence(p[:, :, None], p[:, None, :]).sum(axis=0)
    both = rows + rows.T
    assert len(seen) and (both[~np.eye(6, dtype=bool)] == want[~np.eye(6, dtype=bool)]).all()


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER).encode())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def brute_components(values):
    """The smallest value reachable over 3 bits or fewer, for each value."""
    values = sorted(set(values))
    label = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            low = min(label[b] for b in values if (a ^ b).bit_count() <= 3)
            if low < label[a]:
                label[a], changed = low, True
    return label


def test_classes_are_those_of_brute_force(spark, monkeypatch):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(i, base.replace(f"word{i}", f"other{i}")) for i in range(1, 25)]
    rows += [(100, base.upper()), (101, base), (102, None), (None, "\t \n"), (103, "One  Two"),
             (104, "one\ntwo"), (None, "lonely 中 text of null id"), (101, base)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    prints = [fingerprint(t) for _, t in rows]
    label = brute_components(prints)
    first = {}
    for (doc_id, _), fp in zip(rows, prints, strict=True):
        first.setdefault(label[fp], []).append(doc_id)
    want = Counter(
        (doc_id, f"{fp:016x}", min((x for x in first[label[fp]] if x is not None), default=None))
        for (doc_id, _), fp in zip(rows, prints, strict=True)
    )
    assert Counter(tuple(r) for r in sim_hash_classes(docs).collect()) == want
    assert Counter(tuple(r) for r in sim_hash_classes(docs, block=2).collect()) == want
    assert sim_hash_classes(docs.limit(0)).count() == 0


def test_long_texts_have_the_shingles_of_the_whole():
    text = b"a bb  ccc\td e\nff " * 40
    whole = np.concatenate(list(sim_hash._shingle_hashes(text)))
    assert np.array_equal(np.concatenate(list(sim_hash._shingle_hashes(text, 11))), whole)
    assert len(whole) == 6 * 40 - 2


@pytest.mark.parametrize("block", [2048, 3])
def test_no_link_is_lost_in_a_hot_key(spark, block):
    """Hundreds of fingerprints around one: chains of links, many of them longer than 3 bits."""
    draw = np.random.default_rng(9)
    centre = int(draw.integers(0, 1 << 63))
    near = [centre ^ sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 6))) for _ in range(300)]
    far = [int(x) for x in draw.integers(0, 1 << 63, 50)]
    signed = [v - (1 << 64) if v >> 63 else v for v in {*near, *far}]
    links = near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), block)
    labels = {r["node"]: r["label"] for r in linked_components(links).collect()}
    want = brute_components([v & (1 << 64) - 1 for v in signed])
    groups, found = defaultdict(set), defaultdict(set)
    for v in signed:
        groups[want[v & (1 << 64) - 1]].add(v)
        found[labels.get(v, v)].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1100)] + [(1000, 1001), (1005, 1005)]
    frame = spark.createDataFrame(chain + star, "a long, b long")
    labels = {r["node"]: r["label"] for r in linked_components(frame).collect()}
    assert set(labels) == {*range(201), *range(1000, 1100)}
    assert all(v == (0 if k < 201 else 1000) for k, v in labels.items())
    assert linked_components(frame.limit(0)).count() == 0
