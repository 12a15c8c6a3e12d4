"""Each operator against a brute-force version on small tables, and on rows that are missing, empty or repeated."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import (
    caps, components, hpylm, langid, mixing, packing, quality_pu, quality_rules, simhash, substring, toxicity,
)

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
VOCABULARY = ["".join(p) for p in itertools.product(["ba", "ko", "ri", "mu", "se"], ["n", "l", "t"], ["a", "o", "i"])]


def sentence(rng, n=12):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n)) + "."


def corpus(n=120, seed=5):
    """Documents with exact copies, near copies, a shared line, very long, empty and NULL texts."""
    rng = random.Random(seed)
    texts = [" ".join(sentence(rng) for _ in range(rng.randrange(2, 30))) for _ in range(n)]
    for i in range(0, n, 7):
        texts[i] = texts[1]
    for i in range(3, n, 11):
        words = texts[2].split()
        words[rng.randrange(len(words))] = "changed"
        texts[i] = " ".join(words)
    shared = sentence(rng, 60)
    for i in range(4, n, 9):
        texts[i] = f"{sentence(rng)}\n{shared}\n{sentence(rng)}"
    texts[5], texts[6], texts[8], texts[10] = None, "", " \t\n", " ".join(sentence(rng) for _ in range(3000))
    return [(i, t, "xx", "s", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).cache()


def brute_components(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 400)]
    links += [(500 + i, 500 + (i + 1) % 37) for i in range(37)] + [(rng.randrange(600, 900), rng.randrange(600, 900)) for _ in range(150)]
    rng.shuffle(links)
    got = components.connected_components(spark.createDataFrame(links + [(7, None)], "a BIGINT, b BIGINT"), "a", "b")
    want = brute_components({x for link in links for x in link}, links)
    for x in {a for a, b in links if a == b}:
        if all(a == b for a, b in links if x in (a, b)):
            want.pop(x)
    assert {r.node: r.component for r in got.collect()} == want


def brute_fingerprint(text):
    ws = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()]
    shingles = [" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.covering_masks(4)
    rng = random.Random(1)
    assert len(masks) == 31
    for _ in range(3000):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not flips & m for m in masks)


@pytest.mark.parametrize("block", [simhash.BLOCK, 2])
def test_fingerprint_links_equal_all_pairs(spark, block):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(8)]
    fps = {0, 1, 2**64 - 1} | {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) % 2**64 for b in base for _ in range(12)}
    signed = {x - 2**64 if x >> 63 else x: x for x in fps}
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp BIGINT"), block=block)
    got = {r.node: r.component for r in components.connected_components(links, "a", "b").collect()}
    pairs = [(a, b) for a, b in itertools.combinations(signed, 2) if (signed[a] ^ signed[b]).bit_count() <= 4]
    assert {i: got.get(i, i) for i in signed} == brute_components(signed, pairs)


def test_simhash_groups(docs):
    rows = corpus()
    fps = {i: brute_fingerprint(t) for i, t, *_ in rows}
    pairs = [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = brute_components(fps, pairs)
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.fp % 2**64 for r in got} == fps
    assert {r.doc_id: r.component_id for r in got} == want and want[5] == want[6] == want[8] == 5


def test_packing_is_gapless_and_round_trips(docs):
    tokens = packing.Tokens()
    rows = packing.pack(docs, shard_docs=50).collect()
    ids = {i: [*tokens(t), 2] for i, t, *_ in corpus()}
    seen = Counter()
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert len(part) == r.length <= 1024 and zlib.crc32(part.tobytes()) == r.ids_crc32
        assert r.piece == 0 or r.length == 1024
        seen[r.doc_id] += r.length
    assert seen == {i: len(x) for i, x in ids.items()}
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len(bins) <= 1.1 * sum(seen.values()) / 1024 + 3


def test_fast_ids_equal_the_tokenizer():
    tokens, rng = packing.Tokens(), random.Random(4)
    texts = ["a<|endoftext|>b", "  x\n\n\ty  ", "'S it's WE'LL", "ß漢字🙂 1²³   z", "a" * 5000, *[
        "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x3000), 0x1F600, 10, 32])) for _ in range(80))
        for _ in range(300)
    ]]
    for text in texts:
        assert tokens(text) == tokens.exact.encode(text, add_special_tokens=False).ids


def test_sum_of_squares_places_where_the_sum_is_smallest():
    rng = random.Random(6)
    sizes = np.array([rng.randrange(1, 41) for _ in range(300)])
    bins, offsets = packing.sum_of_squares(sizes, 40)
    level, opened = {}, Counter()
    for s, b, o in zip(sizes.tolist(), bins.tolist(), offsets.tolist()):
        def after(gap):
            new = opened.copy()
            new[gap] -= 1
            if gap > s:
                new[gap - s] += 1
            return sum(x * x for x in new.values())
        room = [g for g, n in opened.items() if n and g >= s]
        gap = 40 - level.get(b, 0)
        assert o == level.get(b, 0)
        if room:
            assert b in level and after(gap) == min(map(after, room))
            opened[gap] -= 1
        else:
            assert b not in level
        level[b] = level.get(b, 0) + s
        if level[b] < 40:
            opened[40 - level[b]] += 1


def test_repeats_are_cut_and_offsets_hold(docs):
    rows = sorted((i, t) for i, t, *_ in corpus())
    seen, want = set(), {}
    for i, text in rows:
        cuts = []
        for a, b, unit in substring.units(text or ""):
            if unit in seen:
                cuts.append((a, b))
            seen.add(unit)
        want[i] = (None if text is None else substring.cut_out(text, cuts), cuts)
    got = {r.doc_id: (r.text, [(x.start, x.end) for x in r.removed]) for r in substring.remove_repeats(docs).collect()}
    assert got == want
    shared = [i for i in range(4, 120, 9) if i % 7 and i % 11 != 3 and i > 10]
    assert all(want[i][1] for i in shared[1:])


def test_units_find_a_passage_set_into_other_lines():
    rng = random.Random(8)
    passage = " ".join(sentence(rng) for _ in range(6))
    one = {u for *_, u in substring.units(f"{sentence(rng)} Start {passage} and on {sentence(rng)}")}
    two = {u for *_, u in substring.units(f"{sentence(rng)}\n{passage}\nEnd.")}
    assert len(one & two) >= 4


def unspaced(rng, n):
    return "".join(chr(0x4E00 + rng.randrange(900)) for _ in range(n))


@pytest.mark.parametrize("kind", ["short", "mixed", "unstopped", "unspaced", "unspaced unstopped"])
def test_passages_of_sixty_words_are_found_between_other_text(kind):
    """Of each passage between different text, some unit is shared and most of its words are in shared units."""
    rng, shares = random.Random(18), []

    def some(words):
        out, n = [], 0
        while n < words:
            k = {"short": rng.randrange(6, 9), "mixed": rng.randrange(5, 10)}.get(kind, rng.randrange(6, 15))
            n += k
            unit = unspaced(rng, 2 * k) if "unspaced" in kind else sentence(rng, k)
            out.append(unit.rstrip(".") if "unstopped" in kind else unit.rstrip(".") + ("。" if kind == "unspaced" else "."))
        return ("" if "unspaced" in kind else " ").join(out) + ("" if "unspaced" in kind else " ")

    for _ in range(100):
        passage = some(60)
        one = some(rng.randrange(5, 60)) + passage + some(rng.randrange(5, 60))
        two = some(rng.randrange(5, 60)) + passage + some(rng.randrange(5, 60))
        known, marked = {u for *_, u in substring.units(one)}, set()
        for a, b, unit in substring.units(two):
            assert unit == " ".join(two[a:b].lower().split())
            if unit in known:
                marked |= set(range(a, b))
        start = two.index(passage)
        shares.append(len(marked & set(range(start, start + len(passage)))) / len(passage))
    assert np.mean([x > 0 for x in shares]) >= 0.99 and np.mean(shares) > 0.6


def numpy_rake(cells, targets, total):
    w = {k: float(v) for k, v in cells.items() if v > 0}
    for _ in range(500):
        for d, target in enumerate(targets):
            sums = Counter()
            for k, v in w.items():
                sums[k[d]] += v
            w = {k: v * target[k[d]] * total / sums[k[d]] for k, v in w.items()}
    return w


def test_raking_meets_its_targets(spark):
    rng = random.Random(9)
    cells = {(f"s{a}", f"l{b}", f"t{c}"): rng.randrange(1, 900) for a in range(4) for b in range(3) for c in range(2)}
    frame = spark.createDataFrame([(*k, v) for k, v in cells.items()], "source STRING, lang STRING, topic STRING, tokens BIGINT")
    targets = [{f"s{i}": x for i, x in enumerate((0.4, 0.3, 0.2, 0.1))}, {f"l{i}": x for i, x in enumerate((0.5, 0.3, 0.2))}, {"t0": 0.6, "t1": 0.4}]
    given = {
        d: spark.createDataFrame(list(t.items()), f"{d} STRING, share DOUBLE") for d, t in zip(mixing.DIMENSIONS, targets)
    }
    got = {(r.source, r.lang, r.topic): r.weight for r in mixing.rake(frame, given).collect()}
    want = numpy_rake(cells, targets, sum(cells.values()))
    assert all(math.isclose(got[k], want[k], rel_tol=1e-4) for k in want)


def test_mixing_samples_by_calibrated_probabilities(spark):
    rng = random.Random(11)
    rows = [(i, sentence(rng, rng.randrange(5, 40)), rng.choice(["a", "a", "b"]), rng.choice("pppq"), 0) for i in range(800)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS), power=0.5).collect()
    assert max(r.probability for r in got) == 1.0 and min(r.probability for r in got) > 0
    expected, drawn = sum(r.probability for r in got), sum(r.sampled for r in got)
    assert abs(drawn - expected) < 4 * math.sqrt(expected)
    mass = Counter()
    for r in got:
        mass[r.source] += r.tokens * r.probability
    natural = Counter()
    for r in got:
        natural[r.source] += r.tokens
    want = {k: math.sqrt(v) for k, v in natural.items()}
    for k in want:
        assert math.isclose(mass[k] / sum(mass.values()), want[k] / sum(want.values()), rel_tol=1e-4)


def test_a_token_budget_is_kept_and_one_rare_document_changes_little(spark):
    rng = random.Random(13)
    rows = [(i, sentence(rng, rng.randrange(20, 60)), rng.choice(["a"] * 8 + ["b"]), rng.choice("pppppq"), 0) for i in range(1500)]
    kept, gaps = [], []
    for more in ([], [(9000, "five words of another tongue", "rare", "only", 0)]):
        got = mixing.mix(spark.createDataFrame(rows + more, DOCS), power=0.5, keep=0.8).collect()
        total = sum(r.tokens for r in got)
        assert math.isclose(sum(r.tokens * r.probability for r in got), 0.8 * total, rel_tol=1e-9)
        kept.append(sum(r.sampled for r in got if r.doc_id < 9000) / len(rows))
        gaps.append(got[0].gap)
        assert all(0 < r.probability <= 1 for r in got) and len({r.gap for r in got}) == 1
        # what is not kept whole stands in the proportions of the weights
        part = [r for r in got if r.probability < 1]
        assert max(r.probability / r.weight for r in part) - min(r.probability / r.weight for r in part) < 1e-9
    assert abs(kept[0] - kept[1]) < 0.01
    assert gaps[0] <= mixing.TOLERANCE < gaps[1] < 0.1  # a value found with one other value alone cannot meet both
    everything = mixing.mix(spark.createDataFrame(rows[:50], DOCS), keep=1.0).collect()
    assert all(r.sampled and r.probability == 1 for r in everything)


def test_rare_values_are_one_class(spark):
    cells = [("s", "l", "t", 10_000), ("s", "m", "t", 5), ("r", "l", "t", 4), ("r", "n", "u", 3)]
    frame = spark.createDataFrame(cells, "source STRING, lang STRING, topic STRING, tokens BIGINT")
    got = {(r.source, r.lang, r.topic): (r._source, r._lang, r._topic) for r in mixing.pooled(frame, 0.01).collect()}
    assert got == {
        ("s", "l", "t"): ("s", "l", "t"), ("s", "m", "t"): ("s", "(rest)", "t"), ("r", "l", "t"): ("(rest)", "l", "t"),
        ("r", "n", "u"): ("(rest)", "(rest)", "(rest)"),
    }
    assert all(a == b for a, b in {(r.lang, r._lang) for r in mixing.pooled(frame, 0.0).collect()})


def test_contradictory_and_unknown_targets_are_errors(spark):
    cells = spark.createDataFrame([("s", "l", "t", 60), ("r", "m", "t", 40)], "source STRING, lang STRING, topic STRING, tokens BIGINT")

    def shares(dimension, **values):
        return spark.createDataFrame(list(values.items()), f"{dimension} STRING, share DOUBLE")

    against = {"source": shares("source", s=0.5, r=0.5), "lang": shares("lang", l=0.8, m=0.2)}
    with pytest.raises(ValueError, match="contradict"):
        mixing.rake(cells, against)
    fitted, gap = mixing.fit(cells, against)
    assert gap > 0.2 and fitted.count() == 2
    with pytest.raises(ValueError, match="no tokens for the target of lang z"):
        mixing.rake(cells, {"lang": shares("lang", l=0.5, z=0.5)})
    assert math.isclose(sum(r.weight for r in mixing.rake(cells, {"lang": shares("lang", l=0.8, m=0.2)}).collect()), 100)


def test_caps_find_nearly_all_pairs(spark):
    rng = np.random.default_rng(12)
    base = rng.standard_normal((60, 32))
    x = np.concatenate([base, base[:20] + 0.2 * rng.standard_normal((20, 32)), base[:1] + 0.1 * rng.standard_normal((70, 32))])
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(500, rows[3][1]), (501, None), (502, [0.0] * 32), (503, [float("nan")] * 32), (504, [None] + [1.0] * 31),
             (505, []), (506, rows[3][1][:31]), (507, [float("inf")] + [1.0] * 31)]
    got = {r.vec_id: r for r in caps.near_duplicates(
        spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>"), together=16).collect()}
    usable = [i for i in range(150)] + [500]
    y = np.array([rows[i][1] if i < 500 else rows[3][1] for i in usable])
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.9
    np.fill_diagonal(near, False)
    want = {i: int(n) for i, n in zip(usable, near.sum(axis=1))}
    found = sum(got[i].n_links for i in usable)
    assert all(got[i].n_links <= want[i] for i in usable) and found >= 0.97 * sum(want.values())
    assert got[500].component_id == got[3].component_id == 3 and got[500].n_links >= 1
    for i in range(501, 508):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


@pytest.mark.parametrize("n", [2_000, 100_000, 1_000_000, 10_000_000])
def test_pairs_share_filters_at_every_size(n):
    """Random pairs at the threshold, with the directions that a table of n vectors gets."""
    rng = np.random.default_rng(17)
    x, y = rng.standard_normal((2, 400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + math.sqrt(1 - 0.9**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    code = caps.Code.of(n)
    of = [f.reshape(len(x), -1) for _, f in map(code.decode, (x, y))]
    assert all(f.shape[1] == code.each * code.codes == len(set(f[0])) for f in of)
    shared = np.array([len(set(a) & set(b)) for a, b in zip(*map(np.ndarray.tolist, of))])
    assert shared.mean() > 5 and np.mean(shared > 0) >= 0.99


def brute_counts(text):
    import re
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(marked))


def test_rule_counts():
    rng = random.Random(13)
    texts = [None, "", "\n\n a \n a \n", "a b c a b c a b", "x " * 70, "# * $ <|> é\x85b", *[
        "\n".join(" ".join(rng.choice("abc#") for _ in range(rng.randrange(9))) for _ in range(rng.randrange(9))) for _ in range(60)
    ]]
    for text in texts:
        assert quality_rules.counts(text) == brute_counts(text), text


def labelled_corpus(spark, n=500):
    rng = random.Random(14)
    rows, labels = [], []
    for i in range(n):
        ws = [rng.choice(VOCABULARY) for _ in range(rng.randrange(60, 120))]
        bad, toxic = i % 5 == 0, i % 4 == 1
        if bad:
            ws = [w + rng.choice(["###", "***", "$$$"]) for w in ws]
        if toxic:
            for _ in range(rng.randrange(2, 7)):
                ws.insert(rng.randrange(len(ws)), rng.choice(["grum", "vash", "zork", "blug"]))
        rows.append((i, " ".join(ws), "xx", "s", 0))
        if i % 3:
            labels.append((i, int(not bad), int(toxic)))
    return rows, spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")


def test_classifiers_on_held_out_rows(spark):
    rows, docs, labels = labelled_corpus(spark)
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    pu = {r.doc_id: r.score for r in quality_pu.score(docs, quality_pu.learn(docs, labels)).collect()}
    rules = {r.doc_id: r for r in quality_rules.judge(docs, quality_rules.learn(docs, labels)).collect()}
    tox = {r.doc_id: r for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    good, bad = [i for i in held if i % 5], [i for i in held if i % 5 == 0]
    assert np.mean([pu[g] > pu[b] for g in good for b in bad]) > 0.98
    assert all(rules[i].kept for i in good) and not any(rules[i].kept for i in bad)
    assert all(tox[i].toxic == (i % 4 == 1) for i in held)
    assert all(0 <= r.severity <= 3 for r in tox.values())


def test_features_do_not_depend_on_the_batch():
    from ledgerloom.llm import features
    rng = np.random.default_rng(3)
    model = features.Linear(rng.standard_normal(features.WEIGHTS) * (np.arange(features.WEIGHTS) != features.NOTHING),
                            rng.standard_normal(features.DENSE), 0.1)
    texts = [t for _, t, *_ in corpus()]
    together = model(texts)
    assert np.allclose(together, [model([t])[0] for t in texts])


def test_language_of_held_out_texts(spark):
    rng = random.Random(15)
    sounds = {"aa": ["the", "ing", "shor", "wel"], "bb": ["lich", "ung", "schö", "keit"], "cc": ["ción", "ado", "mente", "ñas"]}
    rows = [
        (i, " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(40)), lang, "s", 0)
        for i, lang in enumerate(rng.choice(list(sounds)) for _ in range(400))
    ] + [(900, None, "aa", "s", 0), (901, "12 34 ...", "aa", "s", 0), (902, "", None, "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in langid.predict(docs, langid.learn(langid.learning_rows(docs))).collect()}
    held = [r for r in rows if r[0] < 900 and zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert np.mean([got[r[0]].lang_pred == r[2] for r in held]) > 0.98
    assert all((got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True) for i in (900, 901, 902))


def test_table_draws_follow_the_exact_conditional():
    d, strength, p, n = 0.6, 2.0, 0.3, 60_000
    drawn = hpylm.tables(np.arange(n, dtype=np.uint64) * np.uint64(977), np.full(n, 3), np.full(n, p), np.full(n, strength), d)
    weight = np.array([(1 - d) * (2 - d) * p, 3 * (1 - d) * p**2 * (strength + d), p**3 * (strength + d) * (strength + 2 * d)])
    assert np.allclose(np.bincount(drawn, minlength=4)[1:] / n, weight / weight.sum(), atol=0.01)


@pytest.mark.parametrize("c", [40, 1_000, 100_000])
@pytest.mark.parametrize("p, strength", [(0.001, 500.0), (0.01, 500.0), (0.002, 20_000.0)])
def test_table_draws_of_large_dishes_level_off(c, p, strength):
    """Against the mean of the conditional by the whole recurrence of the Stirling ratios, one customer at a time."""
    d, n, width = 0.7, 8_000, min(c - 1, 400)
    ratio, t = np.zeros(width), np.arange(1, width + 1)
    with np.errstate(divide="ignore"):
        for k in range(1, c):
            ratio = (1 + (k - (t + 1) * d) * ratio) / (np.concatenate(([0.0], 1 / ratio[:-1])) + k - t * d)
            ratio[k:] = 0
        log = np.concatenate(([0.0], np.cumsum(np.log(p * (strength + d * t) * ratio))))
    weight = np.exp(log - log.max())
    weight /= weight.sum()
    mean = (weight * np.arange(1, width + 2)).sum()
    spread = math.sqrt((weight * (np.arange(1, width + 2) - mean) ** 2).sum())
    drawn = hpylm.tables(np.arange(n, dtype=np.uint64) * np.uint64(977), np.full(n, c), np.full(n, p), np.full(n, strength), d)
    assert abs(drawn.mean() - mean) < 5 * spread / math.sqrt(n) and math.isclose(drawn.std(), spread, rel_tol=0.1)


def test_language_model_keys_in_order_are_stored_as_differences():
    rng = np.random.default_rng(3)
    for bits in (64, 48):  # as many as a chunk has of one part in 64
        keys = np.unique(rng.integers(0, 2**58, 3_000, dtype=np.uint64) >> np.uint64(64 - bits) << np.uint64(64 - bits))
        stored = hpylm.packed_keys(keys)
        assert np.array_equal(hpylm.unpacked_keys(stored), keys) and len(stored) < 0.95 * len(hpylm.packed(keys))
    assert len(hpylm.unpacked_keys(hpylm.packed_keys(keys[:0]))) == len(hpylm.unpacked_keys(None)) == 0


def test_language_model_words_find_their_state_by_place():
    """A chunk's places among a part's keys give what its keys give, in far fewer bytes; unknown words give zeros."""
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2**64, 5_000, dtype=np.uint64))
    learned = np.sort(rng.choice(keys, 3_000, replace=False))
    m, u = (rng.integers(1, 50, len(learned)) for _ in range(2))
    state = hpylm._state(0, "state", learned, m, np.minimum(m, 1), u)
    mine = np.sort(rng.choice(keys, 2_000, replace=False))
    by_place, by_key = hpylm._placed(*hpylm._found(learned, mine)), (hpylm.packed_keys(mine),)
    rows = [
        hpylm._looked_up(hpylm._messages([hpylm._row(1, 0, kind, *stored)]), state, "state", "answer")
        for kind, stored in (("at", by_place), ("asks", by_key))
    ]
    assert rows[0] == rows[1]
    assert 4 * sum(map(len, by_place)) < len(by_key[0])
    own = dict(zip(learned.tolist(), m.tolist()))
    assert hpylm.unpacked(rows[0][0][3], np.int64).tolist() == [own.get(k, 0) for k in mine.tolist()]


def test_language_model_releases_shuffles_before_the_next_step(spark, docs, monkeypatch):
    """What the chunks asked is let go once a later job has run, and before the words are dealt by part."""
    steps = []
    for name in ("saved", "_stats", "_release"):
        def call(*args, name=name, of=getattr(hpylm, name)):
            steps.append(name)
            return of(*args)
        monkeypatch.setattr(hpylm, name, call)
    hpylm.log_likelihood(docs, rounds=2)
    assert steps[:5] == ["saved", "_stats", "_stats", "_release", "saved"]


def test_language_model_base_and_gain(spark, docs):
    got = {r.doc_id: r for r in hpylm.log_likelihood(docs).collect()}
    tokens = {i: [*(t or "").split(), None] for i, t, *_ in corpus()}
    learned = [i for i in tokens if zlib.crc32(str(i).encode()) % 5 != 1]
    count = Counter(w for i in learned for w in tokens[i])
    n, v = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i not in learned, len(ws), sum(count[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), abs_tol=1e-4)
    copies = [i for i in tokens if got[i].held_out and i % 7 == 0]
    assert copies and all(got[i].score > got[i].base_score for i in copies)


def test_language_model_probabilities_sum_to_one(spark):
    """Every one-word text of the vocabulary, an unknown word and the empty text share the first place."""
    rng = random.Random(16)
    vocabulary = ["a", "b", "c", "d"]
    train = [(i, " ".join(rng.choice("aaabbc") for _ in range(9)) + " d") for i in range(2000) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = [i for i in range(2000, 2100) if zlib.crc32(str(i).encode()) % 5 == 1][: len(vocabulary) + 2]
    probes = list(zip(held, [*vocabulary, "zz", ""]))
    docs = spark.createDataFrame([(i, t) for i, t in train + probes], "doc_id BIGINT, text STRING")
    score = {r.doc_id: r.score for r in hpylm.log_likelihood(docs).collect()}
    end = score[held[-1]]
    # P(word) P(end | word) + P(end) is at most one, and the words that start a text take nearly all of it
    assert sum(10 ** score[i] for i in held) <= 1 + 1e-6 and end < -1


MESSY = [
    (1, "One text of words that stands here twice.", "en", "s", 1), (1, "One text of words that stands here twice.", "en", "s", 1),
    (2, None, None, None, None), (None, "A text without a number, of words.", "en", "s", 3), (None, None, None, None, None),
    (3, "", "en", None, 0), (4, " \t\r\n ", None, "s", 4), (5, "x" * 300_000, "de", "s", 9), (6, "ß漢字🙂 " * 50, "fr", "s", 9),
    (1, "Another text under the same number, quite different.", "en", "t", 5),
]
LABELS = "doc_id BIGINT, quality INT, toxic INT"
OPERATORS = {
    "hpylm": lambda d, l: hpylm.log_likelihood(d),
    "simhash": lambda d, l: simhash.near_duplicates(d),
    "mixing": lambda d, l: mixing.mix(d),
    "packing": lambda d, l: packing.pack(d),
    "toxicity": lambda d, l: toxicity.score(d, toxicity.learn(d, l)),
    "langid": lambda d, l: langid.predict(d, langid.learn(langid.learning_rows(d))),
    "substring": lambda d, l: substring.remove_repeats(d),
    "quality_pu": lambda d, l: quality_pu.score(d, quality_pu.learn(d, l)),
    "quality_rules": lambda d, l: quality_rules.judge(d, quality_rules.learn(d, l)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_messy_and_empty_tables(spark, name):
    extra = [F.lit(1).alias(c) for c in ("score", "fp", "chunk", "component", "version", "_spans", "shard", "label", "removed", "tokens", "learn")]
    docs = spark.createDataFrame(MESSY, DOCS).select("*", *extra)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (6, None, None), (None, 1, 1)], LABELS)
    got = OPERATORS[name](docs, labels)
    pieces = 1 if name != "packing" else None
    assert got.count() == len(MESSY) if pieces else got.filter("piece = 0").count() == len(MESSY)
    assert OPERATORS[name](docs.limit(0), labels.limit(0)).count() == 0
    assert OPERATORS[name](docs, labels.limit(0)).count() >= len(MESSY)


def test_vectors_of_an_empty_table(spark):
    assert caps.near_duplicates(spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>")).count() == 0
