"""Operators over documents against plain brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridtide.llm import bpe, line_dedup, lm, minhash, mixing, quality_rules, repair, shared, toxicity

WORD = re.compile("[^\x20\x09-\x0d]+")


def prose(draw, n, vocabulary=400):
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=3):
    """Texts with exact and near copies, shared passages and repeated lines."""
    draw = random.Random(seed)
    base = ["\n".join(prose(draw, draw.randrange(1, 40)) for _ in range(draw.randrange(1, 6))) for _ in range(40)]
    passage = prose(draw, 60)
    texts = list(base)
    for i in range(40):
        words = base[i % 12].split(" ")
        for _ in range(draw.randrange(0, 6)):
            words[draw.randrange(len(words))] = f"edit{draw.randrange(99)}"
        texts.append(" ".join(words))
    texts += [prose(draw, 30) + "\n" + passage + "\n" + prose(draw, 20) for _ in range(8)]
    texts += ["a b c", "a b c", "A B C", "", None, "spam eggs ham spam eggs " * 30]
    return list(enumerate(texts))


def test_word_hashes_agree_with_split():
    draw = random.Random(1)
    texts = ["".join(draw.choice("aB \n\té\x0b|ß") for _ in range(draw.randrange(40))).encode() for _ in range(300)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    found = shared.Words(data, offsets)
    words = [w for t in texts for w in t.lower().split()]
    assert np.diff(found.first).tolist() == [len(t.split()) for t in texts]
    assert [bytes(data[a:b]).lower() for a, b in zip(found.starts, found.ends)] == words
    seen = {}
    for w, h in zip(words, found.hashes.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    data = np.frombuffer(("some words and a_very_long_one " * 20).encode(), np.uint8)
    whole = shared.Words(data, np.array([0, 100, len(data)]))
    monkeypatch.setattr(shared, "CHUNK_BYTES", 16)
    parts = shared.Words(data, np.array([0, 100, len(data)]))
    assert (whole.hashes == parts.hashes).all() and (whole.first == parts.first).all()


def test_components(llm):
    draw = random.Random(4)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in shared.components(llm, llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_base_statistics(llm, documents):
    rows = corpus()
    got = {r["doc_id"]: r for r in quality_rules.op1(llm, documents(rows)).collect()}
    for doc_id, text in rows:
        words, windows, covered = WORD.findall(text or ""), defaultdict(list), set()
        for i in range(len(words) - 7):
            windows[tuple(words[i : i + 8])].append(i)
        for places in windows.values():
            covered.update(j for i in places if len(places) > 1 for j in range(i, i + 8))
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        want = (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))
        r = got[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_estimated_quality(llm, documents):
    """Junk of one kind that a single rule knows is told from good texts, which stay."""
    draw = random.Random(5)
    good = [(i, "\n".join(prose(draw, 30, 5000) for _ in range(5))) for i in range(300)]
    junk = [(1000 + i, " ".join(w + "$$$" for w in prose(draw, 120, 5000).split())) for i in range(30)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.op1(llm, documents(good + junk)).collect()}
    assert all(got[i] for i, _ in good) and not any(got[i] for i, _ in junk)


def verdicts(llm, documents, good, noisy, junk=()):
    got = {r["doc_id"]: r["kept"] for r in quality_rules.op1(llm, documents([*good, *noisy, *junk])).collect()}
    return [[got[i] for i, _ in group] for group in (good, noisy, junk)]


def marked(draw, text, share, mark="#"):
    return " ".join(w + mark if draw.random() < share else w for w in text.split(" "))


def test_a_noisy_rule_is_found_out(llm, documents):
    """A rule that fires alone on a fifth of the good texts rejects none of them."""
    draw = random.Random(8)
    texts = ["\n".join(prose(draw, 30, 5000) for _ in range(5)) for _ in range(300)]
    good = list(enumerate(texts[:240]))
    noisy = [(1000 + i, "\n".join(marked(draw, line, 0.2) for line in t.split("\n"))) for i, t in enumerate(texts[240:])]
    kept = verdicts(llm, documents, good, noisy)
    assert all(kept[0]) and all(kept[1])
    votes = quality_rules.judged(llm, documents(noisy)).select("pattern").distinct().collect()
    place = 3 ** list(quality_rules.default_rules()).index("symbols")
    assert all(r.pattern // place % 3 == quality_rules.BAD for r in votes)


def test_junk_by_agreement(llm, documents):
    """Where rules of a family agree on some texts, a rule of it that fires alone is believed as well."""
    draw = random.Random(9)
    good = [(i, "\n".join(prose(draw, 30, 5000) for _ in range(5))) for i in range(400)]
    heavy = [(1000 + i, marked(draw, prose(draw, 120, 5000), 1.0, "|||")) for i in range(30)]
    light = [(2000 + i, marked(draw, prose(draw, 120, 5000), 0.3)) for i in range(20)]
    kept = verdicts(llm, documents, good, heavy, light)
    assert all(kept[0]) and not any(kept[1]) and not any(kept[2])


def plain_posteriors(counts, families, iterations=30):
    """Expectation-maximisation over vote patterns, written out."""
    q = quality_rules
    kinds = sorted(set(families))
    patterns = sorted(counts)
    votes = {p: [p // 3**j % 3 for j in range(len(families))] for p in patterns}
    post = {}
    for p in patterns:
        bad = [sum(v == q.BAD and f == kind for v, f in zip(votes[p], families)) for kind in kinds]
        good = q.START[min(max(bad), len(q.START) - 1)]
        post[p] = [good] + [(1 - good) * (b / sum(bad) if sum(bad) else 1 / len(kinds)) for b in bad]
    for _ in range(iterations):
        scores = {p: [] for p in patterns}
        for k in range(len(kinds) + 1):
            prior = q.PRIOR_JUNK_VOTES if k else q.PRIOR_GOOD_VOTES
            mass = sum(counts[p] * post[p][k] for p in patterns) + (q.PRIOR_JUNK_DOCS if k else q.PRIOR_GOOD_DOCS)
            rates = []
            for j in range(len(families)):
                bad = sum(counts[p] * post[p][k] for p in patterns if votes[p][j] == q.BAD)
                cast = sum(counts[p] * post[p][k] for p in patterns if votes[p][j] != q.ABSTAIN)
                rates.append(min(1 - q.TINY, max(q.TINY, (bad + prior[0]) / (cast + sum(prior)))))
            for p in patterns:
                said = [0 if v == q.ABSTAIN else math.log(r if v == q.BAD else 1 - r) for v, r in zip(votes[p], rates)]
                scores[p].append(math.log(mass) + sum(said))
        for p in patterns:
            weights = [math.exp(s - max(scores[p])) for s in scores[p]]
            post[p] = [w / sum(weights) for w in weights]
    return {p: post[p][0] for p in patterns}


@pytest.mark.parametrize("seed", range(4))
def test_posteriors_equal_the_plain_estimate(llm, seed):
    draw = random.Random(seed)
    families = draw.choice([list(quality_rules.FAMILIES.values()), ["x"], ["x", "y", "x", "z"]])
    counts = {draw.randrange(3 ** len(families)): draw.choice([1, 3, 40, 2000]) for _ in range(60)}
    frame = llm.createDataFrame(list(counts.items()), "pattern int, n long")
    got = {r["pattern"]: r["posterior"] for r in quality_rules.posteriors(frame.repartition(3), families).collect()}
    want = plain_posteriors(counts, families)
    assert got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)
    assert quality_rules.posteriors(frame.limit(0), families).collect() == []


def lines_left(rows):
    """Brute force of the line dedup: edit similarity of all pairs."""
    def normal(line):
        folded = bytes(line_dedup.FOLDED[list(line.encode())]) if line else b""
        return " ".join(x.decode() for x in re.split(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded) if x)

    places = defaultdict(list)
    for doc_id, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            if len(normal(line).split()) >= line_dedup.MIN_WORDS:
                places[normal(line)].append((doc_id, i))
    names = list(places)
    group = list(range(len(names)))
    for i in range(len(names)):
        for j in range(i):
            if line_dedup.similar_lines(names[i], names[j]):
                group = [group[j] if g == group[i] else g for g in group]
    gone = set()
    for g in set(group):
        gone.update(sorted(p for n, k in zip(names, group) if k == g for p in places[n])[1:])
    return {d: "\n".join(x for i, x in enumerate((t or "").split("\n")) if (d, i) not in gone) for d, t in rows}


def test_line_dedup(llm, documents):
    rows = corpus() + [(500, "The very same, line 17 of words that are many"), (501, "the VERY same line 99 of words that are many!"), (502, "One two three.")]
    draw = random.Random(6)
    long = prose(draw, 400).split(" ")
    rows += [(600, " ".join(long)), (601, " ".join([*long[:200], "changed", *long[201:]]))]
    want = lines_left(rows)
    got = {r["doc_id"]: r for r in line_dedup.op2(llm, documents(rows)).collect()}
    assert {d: r["text_sha256"] for d, r in got.items()} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in want.items()}
    assert got[501]["emptied"] and not got[500]["emptied"] and not got[502]["emptied"]
    kept = line_dedup.deduplicated(llm, documents(rows)).collect()
    assert {r["doc_id"]: r["text"] or "" for r in kept} == {d: t for d, t in want.items() if not got[d]["emptied"]}
    assert all(r["n_chars"] == len(r["text"] or "") for r in kept)


def spelled(draw, n):
    return ["".join(draw.choice("etaoinshrdlucm") for _ in range(draw.randrange(3, 9))) for _ in range(n)]


def test_near_lines_by_edits_alone(llm, documents):
    """All pairs at the edit similarity are found, however many bits of the SimHash differ."""
    draw = random.Random(13)
    lines = []
    for i in range(60):
        words = spelled(draw, draw.choice([10, 15, 25, 60]))
        other = list(words)
        other[draw.randrange(len(words))] = spelled(draw, 1)[0]
        lines += [" ".join(words), " ".join(other)]
    lines += ["ein \u00fcberall \u00f6fter gelesener Satz \u00fcber M\u00fcnchen", "ein \u00fcberall \u00f6fter gelesener Satz \u00fcber M\u00fcnchem"]
    first = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            most = int(max(len(lines[i]), len(lines[j])) * 0.1 + 1e-9)
            if distance(lines[i], lines[j]) <= most:
                first = [first[j] if f == first[i] else f for f in first]
    assert sum(f != i for i, f in enumerate(first)) >= 45
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.op2(llm, documents(list(enumerate(lines)))).collect()}
    assert got == {i: int(f != i) for i, f in enumerate(first)}


def test_met_keys_by_brute_force(llm):
    """Keys of several classes are found with their classes, over parts and runs of held keys."""
    draw = np.random.default_rng(12)
    n, masks = 3000, line_dedup.block_masks()
    sim = draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
    sim[:40] = sim[40:80]
    lists = [draw.integers(0, 1 << 12, draw.integers(1, 29)).tolist() for _ in range(n)]
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    keys, of = line_dedup.class_keys(sim, np.concatenate(lists).astype(np.uint32), first, masks)
    holders = defaultdict(list)
    for key, node in zip(keys.tolist(), (of * 5 + 7).tolist()):
        holders[key].append(node)
    want = sorted((key, node) for key, nodes in holders.items() if len(nodes) > 1 for node in nodes)
    alike = {frozenset(nodes) for nodes in holders.values() if len(nodes) == 2}
    assert all(frozenset((i * 5 + 7, i * 5 + 207)) in alike for i in range(40))
    for i in range(0, n - 1, 2):
        for k, (x, y) in enumerate(zip(lists[i], lists[i + 1])):
            assert x != y or {i * 5 + 7, i * 5 + 12} <= {b for _, b in want}, k
    rows = [(i * 5 + 7, int(s) - (1 << 64) if s >> np.uint64(63) else int(s), x) for i, (s, x) in enumerate(zip(sim, lists))]
    finder = line_dedup.LineDedup.__new__(line_dedup.LineDedup)
    finder.masks = masks
    got = finder.met_keys(llm.createDataFrame(rows, "node long, sim long, bands array<int>").repartition(3))
    assert sorted(map(tuple, got.collect())) == want


def test_sketches_are_not_kept(llm, documents):
    """Lines are not written with their sketches, and keys go with their last reader."""
    draw = random.Random(5)
    finder = line_dedup.LineDedup(llm, documents([(i, prose(draw, 40, 900) + "\n" + prose(draw, 30, 900)) for i in range(60)]))
    assert {purpose for purpose, _ in finder.tables.paths} == {"met-keys", "line-classes"}
    assert "bands" not in finder.classes.columns and "sketch" not in finder.lines.columns
    finder.groups()
    assert "met-keys" not in {purpose for purpose, _ in finder.tables.paths}
    finder.tables.done()


def test_short_lines_and_lines_without_blanks(llm, documents):
    han = "".join(chr(0x4E00 + 37 * i % 2000) for i in range(80))
    texts = ["Accept all cookies\nfirst own words", f"accept ALL cookies!\n{han}\n---", f"{han}\n---\nShare", f"share\n{han[:40]}\u3042{han[41:]}\nfirst other words"]
    got = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(llm, documents(list(enumerate(texts)))).collect()}
    assert got == {0: texts[0], 1: f"{han}\n---", 2: "---\nShare", 3: "first other words"}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    draw = random.Random(7)
    for _ in range(400):
        a = [draw.choice("abc") for _ in range(draw.randrange(70))]
        b = list(a)
        for _ in range(draw.randrange(10)):
            b.insert(draw.randrange(len(b) + 1), draw.choice("abc")) if draw.random() < 0.5 or not b else b.pop(draw.randrange(len(b)))
        most, true = draw.randrange(15), distance(a, b)
        got = line_dedup.edit_distance(a, b, most)
        assert got == true if true <= most else got > most


def test_minhash_components(llm, documents):
    rows = corpus()
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root[a], root[b]
                root = {d: min(x, y) if r in (x, y) else r for d, r in root.items()}
    got = {r["doc_id"]: r for r in minhash.op3(llm, documents(rows)).collect()}
    assert {d: (r["n_shingles"], r["component_id"], r["kept"]) for d, r in got.items()} == {d: (len(sets[d]), root[d], root[d] == d) for d in sets}
    left = {r["doc_id"] for r in minhash.deduplicated(llm, documents(rows)).collect()}
    assert left == {d for d in sets if root[d] == d}


def test_near_copies_are_dropped_by_row(llm, documents):
    """Rows that share an id are judged by their own texts, and one row of a group stays."""
    draw = random.Random(15)
    a, b, c, d = (prose(draw, 80, 5000) for _ in range(4))
    rows = [(1, a), (2, a + " end"), (2, b), (3, c), (3, c), (None, c + " end"), (None, d), (None, d), (4, ""), (4, "")]
    got = [(r["doc_id"], r["text"]) for r in minhash.deduplicated(llm, documents(rows)).collect()]
    assert Counter(got) == Counter([(1, a), (2, b), (3, c), (None, d), (4, ""), (4, "")])


def test_pigeonhole_guarantee():
    """Signatures of keyed slots that differ in at most 31 slots share a key."""
    draw = np.random.default_rng(0)
    for _ in range(200):
        differ = np.zeros(minhash.KEYED, dtype=bool)
        differ[draw.choice(minhash.KEYED, 2 * minhash.CHUNKS - 1, replace=False)] = True
        assert (differ.reshape(-1, minhash.CHUNK).sum(axis=1) <= 1).any()


def test_open_buckets_of_dissimilar_members(llm, documents):
    """A bucket whose members mostly are not similar makes few candidate pairs, and loses no link."""
    draw = random.Random(31)
    base = prose(draw, 150, 5000).split(" ")
    rows = []
    for i in range(150):
        at = sorted(draw.sample(range(150), 4))
        rows.append((i, " ".join(f"{w}{i}" if k in at else w for k, w in enumerate(base))))
    sets = {d: {tuple(t.split(" ")[i : i + 5]) for i in range(146)} for d, t in rows}
    root, pairs = {d: d for d in sets}, 0
    for a in sets:
        for b in sets:
            common, whole = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            pairs += a < b and 100 * common >= 64 * whole
            if a < b and 100 * common >= 75 * whole:
                x, y = root[a], root[b]
                root = {d: min(x, y) if r in (x, y) else r for d, r in root.items()}
    found = minhash.NearDuplicates(llm, documents(rows))
    members = found.buckets()
    none = llm.createDataFrame([], "node long, root long")
    assert found.open_pairs(members, none).count() <= 1.2 * pairs
    assert {r["doc_id"]: r["component_id"] for r in found.result().collect()} == root


def test_toxicity_held_out(llm, documents):
    draw = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        words = prose(draw, draw.randrange(20, 120), 3000).split(" ")
        bad = i % 5 == 0
        for _ in range(3 if bad else 0):
            words[draw.randrange(len(words))] = draw.choice(["nasty", "awful", "vile"])
        rows.append((i, " ".join(words), draw.choice(["en", "de"]), "s"))
        labels.append((i, 1, int(bad)))
    table = llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.op6(llm, documents(rows), table).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in out)
    test = [(r["predicted"], r["doc_id"] % 5 == 0) for r in out if r["held_out"]]
    assert sum(p == y for p, y in test) >= 0.97 * len(test)
    again = toxicity.op6(llm, documents(rows), table).collect()
    assert {(r["doc_id"], r["score"]) for r in out} == {(r["doc_id"], r["score"]) for r in again}
    # Labels of held-out rows, languages and sources do not change a score.
    other = llm.createDataFrame([(d, q, 1 - t if zlib.crc32(str(d).encode()) % 4 == 2 else t) for d, q, t in labels], table.schema)
    moved = toxicity.op6(llm, documents([(d, t, "xx", "z") for d, t, *_ in rows]), other).collect()
    assert {(r["doc_id"], r["score"]) for r in out} == {(r["doc_id"], r["score"]) for r in moved}
    clean = {r["doc_id"] for r in toxicity.cleaned(llm, documents(rows), table).collect()}
    assert len(clean ^ {d for d, *_ in rows if d % 5}) <= 20


def test_thresholds_cover_all_labelled_rows(llm, documents):
    draw = random.Random(14)
    rows, labels = [], []
    for i in range(900):
        words = prose(draw, draw.randrange(20, 60), 3000).split(" ")
        if i % 5 == 0:
            words[3] = draw.choice(["nasty", "vile"])
        rows.append((i, " ".join(words), "fr" if i % 50 == 0 else "en", "s"))
        labels.append((i, 1, int(i % 5 == 0)))
    docs, table = documents(rows), llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model, fitted = toxicity.fit(docs, table, sample=250)
    counts = toxicity.reached(llm, docs, table, llm.sparkContext.broadcast(model), fitted).collect()
    free = {d for d, *_ in rows if zlib.crc32(str(d).encode()) % 4 != 2} - set(fitted.to_pylist())
    assert len(fitted) == 200 and sum(r["n"] for r in counts) == len(free) > 400
    assert sum(r["n"] for r in counts if r["toxic"]) == sum(d % 5 == 0 for d in free)


def test_thresholds_pool_languages():
    """A language with few toxic rows gets the threshold of all languages, not a fixed one."""
    counts = [("en", 1, 9, 40), ("en", 0, 7, 60), ("en", 0, 0, 500), ("fr", 1, 9, 5), ("fr", 0, 6, 9), (None, 0, 0, 3)]
    got = toxicity.calibrated(counts)
    assert set(got) == {None, "en"} and got[None] == got["en"] == 0.45
    assert toxicity.calibrated(counts[3:]) == {None: toxicity.CUT}


TEXTS = ["", None, "It's they'll 12 345 ...!", "tabs\t\tand  blanks \n\n here   x", "naïve Ünïcödé 🙂🙂 日本語", "a" * 3000, " " * 300 + "x", "<|endoftext|> <|ENDOFTEXT|> \x01 y"]


def test_byte_bpe(llm, documents, monkeypatch):
    draw = random.Random(9)
    rows = list(enumerate(TEXTS + ["".join(draw.choice(["ab", " ", "'s", "\n", "9", "é", "!"]) for _ in range(draw.randrange(3000))) for _ in range(20)]))
    enc = bpe.encoding()
    for chunk, overlap in ((1 << 16, 1 << 10), (256, 64)):
        monkeypatch.setattr(bpe, "CHUNK", chunk)
        monkeypatch.setattr(bpe, "OVERLAP", overlap)
        text = {d: t or "" for d, t in rows}
        for t in text.values():  # the stitches in this process; Spark's workers use the module's own sizes
            bodies = [t[a : a + chunk + overlap] for a in range(0, len(t), chunk)]
            ends = [bpe.boundaries(b) for b in bodies]
            heads = {c: [e for e in x if e < overlap] for c, x in enumerate(ends)}
            tails = {c: [e - chunk for e in x if e >= chunk] for c, x in enumerate(ends)}
            cuts = [0, *bpe.stitches(heads, tails, len(bodies)), len(t)]
            ids = [i for a, b in zip(cuts, cuts[1:]) for i in enc.encode_ordinary(t[a:b])]
            assert ids == enc.encode_ordinary(t)
    got = {r["doc_id"]: r for r in bpe.op7(llm, documents(rows)).collect()}
    for d, t in rows:
        ids = enc.encode_ordinary(t or "")
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        assert tuple(got[d])[1:] == want
    back = bpe.decoded(bpe.encoded(llm, documents(rows))).collect()
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in back} == {d: t or "" for d, t in rows}


def test_byte_bpe_long_texts(llm, documents):
    draw = random.Random(10)
    rows = [(i, prose(draw, 40_000)) for i in range(3)] + [(9, "y" * 200_000)]
    got = {r["doc_id"]: r for r in bpe.op7(llm, documents(rows)).collect()}
    for d, t in rows:
        ids = bpe.encoding().encode_ordinary(t)
        assert got[d]["n_tokens"] == len(ids) and got[d]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_shards(llm, documents, tmp_path):
    rows = [(d * 3, t) for d, t in corpus() + list(enumerate(TEXTS, 1000))]
    encoder = repair.WordEncoder()
    ids = {d: [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, repair.END] for d, t in rows}
    got = {r["doc_id"]: r for r in repair.op10(llm, documents(rows)).collect()}
    start = 0
    for d in sorted(ids):
        assert tuple(got[d]) == (d, start, len(ids[d]), zlib.crc32(np.array(ids[d], "<u4").tobytes()))
        start += len(ids[d])
    path = str(tmp_path / "shards")
    repair.write_shards(documents(rows), path)
    for d in (0, 3000, 3006):
        assert repair.document(llm, path, d).first()["ids"] == ids[d]
    assert repair.document(llm, path, 1).count() == 0


@pytest.mark.parametrize("ids", [[], [5], [1] * 500, list(range(50)) * 40, [7, 7, 8] * 300])
def test_grammar_round_trip(ids):
    lengths = np.array([len(ids) // 2, 0, len(ids) - len(ids) // 2])
    rules, symbols, counts = repair.compress(np.array(ids, dtype=np.int64), lengths, 100)
    long = repair.rule_lengths(rules, 100)
    assert repair.decode(symbols, rules, long, 100).tolist() == ids
    ends = np.cumsum(counts)
    for a, b, n in zip(ends - counts, ends, lengths):
        assert len(repair.decode(symbols[a:b], rules, long, 100)) == n
    assert len(ids) < 500 or len(symbols) < 0.7 * len(ids)


def test_lm_base_and_gain(llm, documents):
    draw = random.Random(11)
    kinds = [[f"{k}{i}" for i in range(150)] for k in ("alpha", "beta", "gamma")]
    rows = [(i, " ".join(draw.choice(kinds[i % 3]) for _ in range(draw.randrange(5, 80)))) for i in range(400)] + [(900, None), (901, "")]
    tokens = {d: [*(t or "").lower().split(), None] for d, t in rows}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows}
    counts = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in lm.op8(llm, documents(rows)).collect()}
    for d, ws in tokens.items():
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[d], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(base, abs=1e-6)
    assert sum(got[d]["score"] for d in held if held[d]) > sum(got[d]["base_score"] for d in held if held[d])


def test_lm_is_causal_and_windows_agree():
    draw = np.random.default_rng(1)
    w = {n: (draw.standard_normal(s) * 0.3).astype(np.float32) for n, s in lm._PARAMETERS.items()}
    net = lm.Network(np.zeros(lm.SUBWORDS, np.uint8), w)
    vectors, classes = draw.standard_normal((40, lm.DIM)).astype(np.float32), draw.integers(0, lm.CLASSES, 40)
    lengths = np.array([0, 3, 70, 16, 33])
    first = np.concatenate([[0], np.cumsum(lengths)])
    place = draw.integers(0, 40, first[-1])
    x, full, begin, _, at = lm.inputs(w, vectors, place, first)
    assert np.abs(lm.attention(w, x, full)[-1][at] - lm.states(w, x, begin)[at]).max() < 1e-4
    one = lm.class_scores(net, vectors, classes, place, first)
    later = place.copy()
    later[40:73] = draw.integers(0, 40, 33)  # the last words of the third text
    two = lm.class_scores(net, vectors, classes, later, first)
    same = int(first[2] + 2 + (40 - first[2]))
    assert np.allclose(one[:same], two[:same], atol=1e-6) and not np.allclose(one[same:], two[same:])


def test_mix_near_targets(llm, documents):
    draw = random.Random(12)
    rows = [(i, prose(draw, draw.randrange(1, 60)), "en", draw.choice("abcdefg") if i % 9 else None) for i in range(1500)]
    rows += [(5000, None, "en", "zero"), (5001, "", "en", "zero")]
    docs = documents(rows)
    out = mixing.plan(llm, docs).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        assert r["copies"] <= 3
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, fixed = {}, set()
    while True:  # reshare again and again
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in fixed)
        free = sum(weight[s] for s in order if s not in fixed)
        want = {s: 3 * sizes[s] if s in fixed else rest * weight[s] / free for s in order}
        over = {s for s in order if want[s] > 3 * sizes[s] + 1e-9} - fixed
        if not over:
            break
        fixed |= over
    assert target == pytest.approx(want)
    assert all(abs(taken[s] - want[s]) <= 0.15 * want[s] + 60 for s in order)
    copies = Counter(r["doc_id"] for r in mixing.mixed(llm, docs).collect())
    assert copies == Counter({r["doc_id"]: r["copies"] for r in out if r["copies"]})


def test_only_texts_with_special_names_are_encoded_whole(monkeypatch):
    texts = ["Plain words \x01 and more.", "with <|endoftext|> in it", "", "<| endoftext |>x", "Ünïcode wörds <", "| plain again"] * 3
    encoder = repair.WordEncoder()
    whole = []
    direct = encoder._direct
    monkeypatch.setattr(encoder, "_direct", lambda text: whole.append(text) or direct(text))
    data = [t.encode() for t in texts]
    ids, lengths = encoder.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for one in want for i in one] and lengths.tolist() == [len(one) for one in want]
    assert set(whole) == {t for t in texts if "<|" in t}
