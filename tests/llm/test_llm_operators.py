"""Every operator against a brute-force version or an exact round trip, on edge cases and on the smallest tables."""

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from freightlens.llm import chat_windows, dart_minhash, fertility, fuzzy_lines, latent_decontamination, mixing, similar, substring_dedup, token_files, toxicity, warc
from freightlens.llm.common import folded, hashed_words, steps, table, words_of
from freightlens.llm.components import components
from freightlens.llm.queries import QUERIES, STATEMENTS

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def rows(folder, name):
    return duckdb.sql(f"SELECT * FROM '{folder}/{name}.parquet'").fetchall()


def prose(n, seed):
    r = random.Random(seed)
    return [r.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(r.randrange(300)) for _ in range(n)]


def test_words_and_hashes():
    texts = [None, "", "a\u00a0b c", " x  y\n", "é" * 300_000 + " tail", "z " * 200_000]
    assert [[w.decode() for w in words_of(t)] for t in texts] == [words(t) for t in texts]
    found = hashed_words(texts)
    assert [len(h) for h in found] == [len(words(t)) for t in texts]
    assert hashed_words(["x y"])[0].tolist() == found[3].tolist() and len(set(found[5].tolist())) == 1


def test_fertility(spark, documents):
    texts = [None, "", "one", " ".join(prose(80, 1)), "a b c " * 40, "q\nq\n \nq # $", " ".join(prose(80, 2)), "日本語 " * 60]
    docs = documents(texts, lang=["en", None, "en", "en", "en", None, "en", None])
    got = {r.doc_id: r for r in fertility.judge(steps(spark), docs).collect()}
    for i, t in enumerate(texts):
        w, lines = words(t), (t or "").split("\n")
        windows = Counter(zip(w, w[1:], w[2:]))
        inside = {j + k for j, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
        dup = sum(1 for j, x in enumerate(lines) if words(x) and x in lines[:j])
        base = (len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), dup, len(inside))
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == base
        assert g.base_failed == (len(w) < 50 or 100 * len(inside) > 50 * len(w))
        assert not (g.kept and g.base_failed)
    assert got[3].kept and got[6].kept and got[7].base_failed
    assert got[7].band_key != got[5].band_key and got[0].n_tokens == 0


def test_fertility_bands_reject_junk(spark):
    """Documents of quality 0 that pass the base rules go, those of quality 1 stay; the bands alone tell them apart."""
    folder = "/root/testdata/sf0.1"
    quality = {r[0]: r[1] for r in rows(folder, "labels")}
    got = [r for r in QUERIES["op1_tokeniser_fertility"](spark, folder).collect() if not r.base_failed and quality.get(r.doc_id) is not None]
    junk, clean = ([r.kept for r in got if quality[r.doc_id] == q] for q in (0, 1))
    assert len(junk) > 200 and sum(junk) < 0.2 * len(junk)
    assert len(clean) > 2000 and sum(clean) > 0.97 * len(clean)


def test_fertility_rejects_symbols_and_tables(spark, documents):
    def plain(seed):
        r = random.Random(seed)
        many = "river house children under mountain weather because between market evening letter garden winter nothing window several".split()
        return [r.choice(many) + r.choice(["", "s", *many]) for _ in range(200)]

    clean = [" ".join(plain(1000 + n)) for n in range(60)]
    symbols = [" ".join(w + "%*#&"[n % 4] * 3 for n, w in enumerate(plain(2000 + k))) for k in range(4)]
    tables = [" ".join(f"{w} |" if n % 3 else w for n, w in enumerate(plain(3000 + k))) for k in range(4)]
    texts = clean + symbols + tables
    got = {r.doc_id: r for r in fertility.judge(steps(spark), documents(texts, lang=["en"] * len(texts))).collect()}
    assert not any(got[n].base_failed for n in got)
    assert sum(got[n].kept for n in range(60)) >= 57 and not any(got[n].kept for n in range(60, 68))


def test_fertility_encoder_is_per_word():
    encoder = fertility.Encoder(fertility.VOCABULARY)
    sample = ["Haanth.", "日本", "x\u2581y", "a\u00a0b", "##", "\U0001f600"]
    encoder.learn({s.encode() for s in sample})
    assert all(encoder[s.encode()] == encoder._ids(s.encode()) for s in sample)


def multiset_jaccard(a, b, k=5):
    def shingles(t):
        w = words(t)
        n = min(k, len(w))
        return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()

    x, y = shingles(a), shingles(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def brute_classes(texts, linked):
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if linked(texts[i], texts[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))]


def test_dart_minhash_agrees_with_weighted_jaccard():
    a, b = prose(400, 3), prose(400, 3)
    b[100:130] = prose(30, 4)
    sets = [dart_minhash.elements(h) for h in hashed_words([" ".join(a), " ".join(b), "one", " ".join(a + a)])]
    found = dart_minhash.signatures(sets, 2000)
    for i, t in enumerate((a, b, a + a)):
        for j, u in enumerate((a, b, a + a)):
            rows_of = [0, 1, 3]
            true = multiset_jaccard(" ".join(t), " ".join(u))
            assert abs((found[rows_of[i]] == found[rows_of[j]]).mean() - true) < 0.05


def test_near_duplicates(spark, documents):
    base = prose(200, 5)
    texts = [None, "", " ", "one two", "one  two", " ".join(base), " ".join(base) + " "]
    for n in range(25):
        copy = list(base)
        for k in range(n // 4):
            copy[(n * 7 + 23 * k) % 200] = f"new{n}{k}"
        texts.append(" ".join(copy))
    texts += [" ".join(prose(120, 50 + n)) for n in range(10)] + ["loop " * 500, "loop " * 480]
    expected = brute_classes(texts, lambda a, b: bool(words(a)) and words(a) == words(b) or multiset_jaccard(a, b) >= 0.8)
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicate_classes(steps(spark), documents(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == expected
    twice = documents(["a b c d e f"] * 3 + ["x y z"], ids=[7, 7, 9, None])
    assert sorted((r.doc_id or -1, r.class_id or -1) for r in dart_minhash.near_duplicate_classes(steps(spark), twice).collect()) == [(-1, -1), (7, 7), (7, 7), (9, 7)]
    assert dart_minhash.near_duplicate_classes(steps(spark), documents([])).count() == 0


def test_every_pair_is_compared_in_the_end(spark):
    """A chain of which no leader sees more than its neighbours; one band holds everything."""
    sets = {i: list(range(i * 10, i * 10 + 100)) for i in range(12)}
    banded = spark.createDataFrame([(1, i, 100) for i in sets], "band long, node long, n int")
    elements = spark.createDataFrame(list(sets.items()), "node long, e array<long>")
    found = similar.similar_components(steps(spark), banded, lambda wanted: elements.join(wanted, "node"), 0.8, stars=2)
    assert {r.component for r in found.collect()} == {0} and found.count() == 12


def test_rare_elements_find_every_link(spark):
    """Sets of several sizes made of few elements, many of them at a similarity of exactly 4 / 5."""
    draw = random.Random(17)
    sets = {}
    for i in range(160):
        held = set(range(i % 4 * 50, i % 4 * 50 + 9))
        held ^= {draw.randrange(i % 4 * 50, i % 4 * 50 + 12) for _ in range(draw.randrange(4))}
        sets[i] = sorted(held)
    rows = spark.createDataFrame([(n, n % 3, e) for n, e in sets.items()], "node long, component long, e array<long>")
    found = similar._rare_pairs(steps(spark), rows.select("node", "component"), rows.select("node", "e"), 0.8)
    got = {(r.a, r.b) for r in found.collect()}
    links = {
        (a, b) for a in sets for b in sets
        if a < b and a % 3 != b % 3 and 5 * len(set(sets[a]) & set(sets[b])) >= 4 * len(set(sets[a]) | set(sets[b]))
    }
    assert links and links <= got and all(a % 3 != b % 3 for a, b in got)


def brute_cut(docs, length=50):
    first = {}
    for i, t in docs:
        w = words(t)
        for p in range(len(w) - length + 1):
            key = tuple(w[p : p + length])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = {p + k for p in range(len(w) - length + 1) if first[tuple(w[p : p + length])] < i for k in range(length)}
        kept = [x for n, x in enumerate(w) if n not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


def test_substring_dedup(spark, documents):
    shared, other = prose(70, 8), prose(55, 9)
    texts = [None, "", "x", " ".join(shared), " ".join(prose(30, 10) + shared + prose(20, 11)), " ".join(other + shared[:50]), " ".join(shared[:49])]
    texts += [" ".join(other), " ".join(other), "same " * 120, "same " * 60, " ".join(prose(10, 12) + other[3:] + shared[20:])]
    docs = list(enumerate(texts)) + [(4, texts[4]), (40, "t " + " ".join(shared))]
    frame = documents([t for _, t in docs], ids=[i for i, _ in docs])
    for start in (25, 50 // 4 * 2 + 1):
        if 50 % start:
            continue
        got = sorted(tuple(r) for r in substring_dedup.remove_repeats(steps(spark), frame, 50, start).collect())
        assert got == brute_cut(docs)
    got = sorted(tuple(r) for r in substring_dedup.remove_repeats(steps(spark), frame, 48, 12).collect())
    assert got == brute_cut(docs, 48)
    assert substring_dedup.remove_repeats(steps(spark), documents([])).count() == 0


def test_substring_dedup_of_odd_rows(spark, documents):
    """Rows without doc_id come last and are no original; of a doc_id's rows one can be a copy and another hold repeats."""
    last = 10**6
    one, two, three, four = (prose(n, s) for n, s in ((70, 21), (80, 22), (60, 23), (90, 24)))
    docs = [(None, one), (5, one), (6, one), (9, prose(20, 25) + one + prose(9, 26)), (None, prose(15, 27) + one[5:])]
    docs += [(None, two), (None, two), (None, prose(7, 28) + two), (30, three), (31, four), (40, three), (40, prose(5, 29) + four[20:] + three[:30])]
    docs += [(40, prose(60, 30)), (None, three[:49]), (None, []), (7, prose(30, 31) + four)]
    texts = [" ".join(w) for _, w in docs]
    expected = brute_cut([(last if i is None else i, t) for (i, _), t in zip(docs, texts)])
    got = substring_dedup.remove_repeats(steps(spark), documents(texts, ids=[i for i, _ in docs])).collect()
    assert sorted((last if r[0] is None else r[0], *r[1:]) for r in got) == expected


def test_substring_dedup_on_the_tables(spark):
    docs = [(r[0], r[1]) for r in rows(FOLDER, "documents")]
    assert sorted(tuple(r) for r in QUERIES["op3_substring_dedup"](spark, FOLDER).collect()) == brute_cut(docs)


def test_common_length():
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.randrange(6) for _ in range(r.randrange(1, 15))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert latent_decontamination.common_length(a, b)[0] == best[-1][-1]


def test_decontamination(spark, documents):
    items = [" ".join(prose(40, 60 + n)) for n in range(12)] + ["only two", None, ""]
    paraphrase = [w for n, w in enumerate(words(items[3])) if n % 6]
    texts = [None, "", " ".join(prose(200, 80)), " ".join(prose(50, 81)) + " " + items[0].upper() + ", " + " ".join(prose(60, 82))]
    texts += [" ".join(prose(90, 83) + paraphrase), "there are ONLY two! here", items[7], items[7]]
    texts += [" ".join(prose(150, 100 + n)) for n in range(40)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for at_once in (1000, 5):
        got = {r.doc_id: (r.contaminated, r.item_ids) for r in latent_decontamination.contaminated(steps(spark), documents(texts), bench, at_once).collect()}
        assert {i: g[1] for i, g in got.items() if g[0]} == {3: [0], 4: [3], 5: [12], 6: [7], 7: [7]}
    assert not latent_decontamination.contaminated(steps(spark), documents(texts), bench.limit(0)).where("contaminated").count()


def test_decontamination_finds_every_verbatim_item(spark):
    items = [(i, folded(t).split()) for i, t in rows(FOLDER, "benchmark")]
    expected = defaultdict(set)
    for d in rows(FOLDER, "documents"):
        spaced = b" " + b" ".join(folded(d[1]).split()) + b" "
        for i, w in items:
            if w and b" " + b" ".join(w) + b" " in spaced:
                expected[d[0]].add(i)
    got = {r.doc_id: set(r.item_ids) for r in QUERIES["op4_latent_decontamination"](spark, FOLDER).collect()}
    assert all(found <= got[d] for d, found in expected.items())
    assert sum(map(bool, got.values())) <= len(expected) + 3


def test_decontamination_finds_verbatim_items_of_a_large_benchmark(spark, documents):
    """More items than a space has dimensions, in one reading of the documents and in several."""
    items = [" ".join(prose(40, 2000 + n)) for n in range(1100)]
    texts = [" ".join(prose(30, 5000 + n) + [t] + prose(30, 7000 + n)) for n, t in enumerate(items)]
    texts += [" ".join(prose(100, 9000 + n)) for n in range(50)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").repartition(4)
    for at_once in (1000, 2000):
        got = {r.doc_id: r.item_ids for r in latent_decontamination.contaminated(steps(spark), documents(texts), bench, at_once).collect()}
        assert len(got) == len(texts) and all(got[n] == ([n] if n < len(items) else []) for n in got)


def test_decontamination_judges_every_row(spark, documents):
    """Rows of one doc_id, or of none, have a verdict each, however many items there are."""
    items = [" ".join(prose(40, 60 + n)) for n in range(12)]
    clean = [" ".join(prose(100, 300 + n)) for n in range(40)]
    texts = [items[0], clean[0], clean[1], items[1], items[1], None, *clean[2:]]
    ids = [7, 7, None, None, None, None, *range(100, 100 + len(clean) - 2)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for at_once in (1000, 5):
        got = latent_decontamination.contaminated(steps(spark), documents(texts, ids), bench, at_once).collect()
        assert len(got) == len(texts) and Counter((r.doc_id, *r.item_ids) for r in got if r.contaminated) == {(7, 0): 1, (None, 1): 2}
        assert all(r.share == 0 for r in got if not r.contaminated)


def test_decontamination_where_copies_are_common(spark, documents):
    """A passage in 40 % of the rows, whole, cut and edited; words of every document stay stop words."""
    items = [" ".join(prose(40, 60 + n)) for n in range(5)]
    common = "the of and to in a is that it for".split()

    def text(n, inside):
        own = prose(80, 400 + n)
        for k, w in enumerate(common):
            own.insert((n * 7 + k * 11) % len(own), w)
        return " ".join(own[:45] + inside + own[45:])

    def copy(n):
        w = words(items[2])
        return [w, w[8:], [x for k, x in enumerate(w) if k % 6 != n % 6], [f"new{n}{k}" if k % 5 == n % 5 else x for k, x in enumerate(w)]][n % 4]

    texts = [text(n, copy(n) if n < 40 else []) for n in range(100)]
    bench = spark.createDataFrame([*enumerate(items), (5, "that it is")], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in latent_decontamination.contaminated(steps(spark), documents(texts), bench).collect()}
    assert [got[n] for n in range(100)] == [[2]] * 40 + [[]] * 60


def test_decontamination_of_long_items(spark, documents):
    """Items of several passages, copied whole, cut to 75 % and edited; one longer than a space has dimensions times passages."""
    items = [" ".join(prose(n, 60 + n)) for n in (200, 400, 1000, 50)]
    cut = [words(i)[: len(words(i)) * 3 // 4] for i in items]
    edited = [[f"new{n}" if n % 5 == 2 else w for n, w in enumerate(words(i))] for i in items]
    pieces = [p for i, c, e in zip(items, cut, edited) for p in (words(i), c, e)]
    texts = [" ".join(prose(70, 700 + n) + p + prose(40, 800 + n)) for n, p in enumerate(pieces)]
    texts += [" ".join(words(items[2])[:400])] + [" ".join(prose(300, 900 + n)) for n in range(150)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for rank in (256, 5):
        got = latent_decontamination.contaminated(steps(spark), documents(texts), bench, rank=rank).collect()
        assert {r.doc_id: r.item_ids for r in got if r.contaminated} == {n: [n // 3] for n in range(12)}


def test_decontamination_of_short_items_among_rarer_words(spark, documents):
    """Five words of a hundredth of the rows each, copied whole among words that occur once."""
    item = "quick brown foxes jump high"
    texts = [" ".join([f"a{n}x{k}" for k in range(40)] + [words(item)[n % 5]] * (n % 20 < 5)) for n in range(2000)]
    texts += [" ".join([f"b{n}" for n in range(43)] + [item] + [f"c{n}" for n in range(43)])]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = latent_decontamination.contaminated(steps(spark), documents(texts), bench).where("contaminated").collect()
    assert [(r.doc_id, r.item_ids) for r in got] == [(2000, [1])]


@pytest.fixture(scope="module")
def restorer(spark):
    docs = spark.createDataFrame([(i, "you are an idiot and a stupid moron, this is plain trash for all of us to see and hate") for i in range(40)], "doc_id long, text string")
    return toxicity.Restorer(toxicity.language_model(toxicity.gram_counts(docs)))


@pytest.mark.parametrize("written", ["1d10t", "!diot", "i.d.i.o.t", "i d i o t", "idiiiiot", "1-D-1-0-T", "id*i*ot"])
def test_restored(restorer, written):
    assert restorer.text(f"you {written}, see") == "you idiot see"


@pytest.fixture(scope="module")
def insults(spark):
    text = "you are an asshole and a worthless idiot, a stupid ass and a fool, you are a worthless stupid tool, said to me. hello (you), so cool! I am"
    docs = spark.createDataFrame([(i, text) for i in range(40)], "doc_id long, text string")
    return toxicity.Restorer(toxicity.language_model(toxicity.gram_counts(docs)))


@pytest.mark.parametrize(
    "written, meant",
    [("@$$hole", "asshole"), ("4$$hole", "asshole"), ("57upid", "stupid"), ("70ol", "tool"), ("a$$", "ass"), ("worthle$$", "worthless"),
     ("worthle$$!", "worthless"), ('"a$$",', "ass"), ("stu" + "p" * 40 + "id", "stupid"), ("1d10t" * 10, "idiot" * 10),
     ("y o u a r e a w o r t h l e s s i d i o t", "you are a worthless idiot"), ("hello!", "hello"), ("(you),", "you"), ("1,000", "1,000")],
)
def test_restored_wherever_letters_are_hidden(insults, written, meant):
    assert insults.text(f"{written}") == meant


def test_reading_is_the_likeliest():
    """Against every reading of tokens with many states, under a language model in which what comes late decides."""
    restorer = toxicity.Restorer((np.random.default_rng(3).standard_normal((32,) * 4) * 4).astype(np.float32))

    def readings(token):
        found = {("", ""): (0.0, (0, 0, 0))}  # text, last letter
        for at, c in enumerate(token):
            run = len(token[:at]) - len(token[:at].rstrip(c))
            nxt: dict = {}
            for (text, last), (score, state) in found.items():
                options = [(letter, toxicity.SUBSTITUTED) for letter in toxicity.LOOK_ALIKE.get(c, "")]
                if c.isalpha():
                    options += [(c, 0.0)] + ([("", toxicity.TRIPLED if run >= 2 else toxicity.REPEATED)] if c == last else [])
                else:
                    options += [(c, toxicity.KEPT)] + ([("", toxicity.SEPARATED)] if c in toxicity.SEPARATORS else [])
                for letter, weight in options:
                    gain, after = restorer._emit(state, letter) if letter else (0.0, state)
                    key = (text + letter, letter or last)
                    if score + weight + gain > nxt.get(key, (-1e30,))[0]:
                        nxt[key] = (score + weight + gain, after)
            found = nxt
        best: dict = defaultdict(lambda: -1e30)
        for (text, _), (score, state) in found.items():
            best[text] = max(best[text], score + restorer._emit(state, " ")[0])
        return best

    draw = random.Random(5)
    for _ in range(60):
        token = "x" + "".join(draw.choice("!|10$.-i") for _ in range(7)) + "t"
        scores = readings(token)
        assert abs(scores[restorer.viterbi(token)] - max(scores.values())) < 1e-6, token


def test_plain_text_is_left_alone(restorer):
    assert restorer.text("Plain (text), this is a week-day?") .startswith("plain text this is a")
    assert restorer.text("") == "" and restorer.tokens("a b") == ["a", "b"]


def test_toxicity(spark, documents):
    r = random.Random(3)
    texts = [" ".join(prose(60, 200 + n) + (["idiot", "moron"] if n % 5 == 0 else [])) for n in range(300)] + [None, ""]
    r.shuffle(texts)
    labels = spark.createDataFrame([(i, 1 if t and "idiot" in t else 0) for i, t in enumerate(texts)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    docs = documents(texts + ["you 1d10t m0r0n " + " ".join(prose(30, 7))])
    got = {row.doc_id: row.score for row in toxicity.toxicity(steps(spark), docs, labels).collect()}
    assert all((got[i] >= 0.7) == bool(t and "idiot" in t) for i, t in enumerate(texts))
    assert got[len(texts)] >= 0.7 and all(0 <= s <= 1 for s in got.values())
    assert {row.score for row in toxicity.toxicity(steps(spark), docs, labels.limit(0)).collect()} == {0.0}


def test_toxicity_of_no_documents_and_repeated_ids(spark, documents):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    docs = documents([" ".join(prose(40, n) + ["idiot"] * (n % 2)) for n in range(40)] + ["same words"] * 3, ids=[*range(40), 50, 50, None])
    assert toxicity.toxicity(steps(spark), docs.limit(0), labels).count() == 0
    got = toxicity.toxicity(steps(spark), docs, labels).collect()
    assert len(got) == 43 and len({r.score for r in got if r.doc_id in (50, None)}) == 1


def test_toxicity_held_out(spark):
    toxic = {r[0]: r[2] for r in rows("/root/testdata/sf0.01", "labels")}
    got = [r for r in QUERIES["op5_noisy_channel_toxicity"](spark, "/root/testdata/sf0.01").collect() if r.doc_id in toxic]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == toxic[r.doc_id] for r in held) / len(held) > 0.9
    assert sum(r.predicted for r in held if not toxic[r.doc_id]) <= 0.02 * len(held)


def brute_warc(pages):
    first = {}
    for i, _, html in pages:
        first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), sha, "response" if first[html or ""] == i else "revisit", None if first[html or ""] == i else first[html or ""]))
    return sorted(out)


def test_warc(spark):
    random.seed(4)
    noise = "".join(chr(random.randrange(32, 0x2FF)) for _ in range(60_000))
    pages = [(1, "http://a/b c\n", "x"), (2, None, None), (3, "u", ""), (4, "u", "x"), (9, "u", "WARC/1.1\r\n\r\n"), (7, "u", noise), (8, "v", noise)]
    ws = steps(spark)
    archives = warc.write_archives(ws, spark.createDataFrame(pages, "page_id long, url string, html string"), ws.path("warc"))
    for split in (1 << 23, 997, 64):
        got = warc.read_archives(archives, split).collect()
        assert sorted(tuple(r)[:5] for r in got) == brute_warc(pages)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(ws, empty, ws.path("none"))).count() == 0


def test_damaged_archives_are_noticed(spark, tmp_path):
    """Any record with a changed byte in its header or content, cut off or with something in between raises, for every way of splitting."""
    pages = [(i, f"http://h/{i}", " ".join(prose(200, i))) for i in range(6)]
    ws = steps(spark)
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    paths = [r.path for r in warc.write_archives(ws, df, ws.path("whole")).collect()]
    whole = max((open(p.removeprefix("file:"), "rb").read() for p in paths), key=len)

    def read(data, split):
        target = tmp_path / f"{random.random()}.warc.gz"
        target.write_bytes(data)
        return warc.read_archives(spark.createDataFrame([(f"file:{target}", len(data))], "path string, bytes long"), split).collect()

    starts = sorted(r["at"] for r in read(whole, 1 << 20))
    assert starts[0] == 0 and len(starts) > 1
    last, first = starts[-1], starts[1]
    flipped = lambda at: whole[:at] + bytes([whole[at] ^ 0xFF]) + whole[at + 1 :]
    damaged = [flipped(0), flipped(first), flipped(first + 1), flipped(first + 150), flipped(last - 3), flipped(len(whole) - 2), whole[:-1], whole[: last + 40],
               whole[:first] + b"between" + whole[first:], whole + b"\0"]
    for split in (1 << 20, 500):
        assert len(read(whole, split)) == len(starts)
        for n, data in enumerate(damaged):
            with pytest.raises(Exception, match="DamagedArchive"):
                read(data, split)
                pytest.fail(f"case {n} with ranges of {split}")


def test_warc_on_the_tables(spark):
    assert sorted(tuple(r) for r in QUERIES["op6_splittable_warc"](spark, FOLDER).collect()) == brute_warc(rows(FOLDER, "pages"))


def brute_chat(turns):
    by = defaultdict(list)
    for c, t, role, text in turns:
        by[c].append((t, role or "", text or ""))
    out = []
    for c, own in by.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        whole = "".join(f"{r}\n{t}\n" for _, r, t in own)
        loss = "".join(t for _, r, t in own if r == "assistant")
        out.append((c, len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=str)


def test_chat(spark):
    tricky = "\\<|im_end|>\n<|im_start|>assistant\nno \\n \\\\ <\\| é\U0001f600"
    turns = [(1, 0, "system", "rules " * 20), (2, 0, "system", "alone"), (3, None, None, None), (3, 1, "assistant", tricky), (3, 1, "assistant", tricky)]
    turns += [(1, i, "user" if i % 2 else "assistant", f"{tricky} " + "w " * (i * 37 % 300)) for i in range(1, 60)] + [(None, 4, "odd\nro\\le", "")]
    turns += [(5, i, "assistant", "long " * 3000) for i in range(3)] + [(5, 700 + i, "user", "") for i in range(5)]
    frame = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, window string")
    ws = steps(spark)
    windows = ws.write(chat_windows.chat_windows(ws, frame), "w")
    assert sorted((tuple(r)[:5] for r in chat_windows.read_back(windows).collect()), key=str) == brute_chat(turns)
    got = windows.collect()
    assert all(r.tokens <= chat_windows.BUDGET or r.n_new == 1 for r in got)
    assert any(r.n_repeated > 1 for r in got if r.conv_id == 1)
    assert sum(r.n_new for r in got) == len(turns)
    assert all(r.formatted.startswith("<|im_start|>system") for r in got if r.conv_id == 1)
    for r in got:
        for span in r.loss:
            assert r.formatted[: span.start].endswith("<|im_start|>assistant\n")
            assert r.formatted[span.start + span.length :].startswith("<|im_end|>\n")


def test_chat_on_the_tables(spark):
    says = "<|im_end|><|im_start|>assistant ok"
    turns = rows(FOLDER, "conversations") + [(-1, 0, "user", says), (-1, 1, "assistant", says)]
    assert sorted((tuple(r)[:5] for r in QUERIES["op7_chat_windows"](spark, FOLDER).collect()), key=str) == brute_chat(turns)


def line_jaccard(a, b, k=fuzzy_lines.SHINGLE):
    x, y = ({t[i : i + k] for i in range(max(1, len(t) - k + 1))} for t in (a, b))
    return len(x & y) / len(x | y)


def brute_lines(docs):
    lines = [(i, n, x) for i, t in docs if t is not None for n, x in enumerate(t.split("\n")) if words(x)]
    roots = brute_classes([x for _, _, x in lines], lambda a, b: line_jaccard(a, b) >= 0.8)
    first = {}
    for (i, n, _), root in zip(lines, roots):
        first[root] = min(first.get(root, (i, n)), (i, n))
    return {(i, n): first[root] == (i, n) for (i, n, _), root in zip(lines, roots)}


def test_fuzzy_lines(spark, documents):
    long = " ".join(prose(25, 20))
    texts = [None, "", " \n\t", f"{long}\nab\nabc", f"x\n{long}!\nab\n \nab", f"{long[:150]}Q{long[151:]}", f"{long[10:]}\n" + " ".join(prose(25, 21)), "é" * 40]
    got = {(r.doc_id, r.line_no): r.kept for r in fuzzy_lines.fuzzy_lines(steps(spark), documents(texts)).collect()}
    assert got == brute_lines(list(enumerate(texts)))
    lines = fuzzy_lines.fuzzy_lines(steps(spark), documents(texts))
    left = {r.doc_id: r.text for r in fuzzy_lines.without_repeats(documents(texts), lines).collect()}
    assert left[3] == texts[3] and left[4] == "x\n " and left[0] is None


def test_sizes_of_line_sets():
    lines = ["a", "ab" * 40, "x" * 30, " ".join(prose(30, 9)), "é" * 3]
    sizes = fuzzy_lines.set_sizes(*fuzzy_lines.shingle_hashes(lines), len(lines))
    assert sizes.tolist() == [len({t[i : i + 6] for i in range(max(1, len(t) - 5))}) for t in lines]
    assert all(fuzzy_lines.set_sizes(*fuzzy_lines.shingle_hashes(["q" * n]), 1).tolist() == [1] for n in (1, 6, 50))


def test_sizes_that_allow_the_similarity_share_a_part(spark):
    sizes = spark.range(1, 400).selectExpr("cast(id as int) n", "7L band")
    parts = {r.n: set(r.p) for r in sizes.select("n", similar._sized_bands(0.8).alias("p")).collect()}
    assert all(parts[n] & parts[m] for n in parts for m in parts if n <= m and 5 * n >= 4 * m)
    assert not parts[10] & parts[30]


def test_fuzzy_lines_on_the_tables(spark):
    docs = [(r[0], r[1]) for r in rows(FOLDER, "documents")][:60]
    frame = table(spark, FOLDER, "documents", "doc_id", "text").where(f"doc_id in ({','.join(str(i) for i, _ in docs)})")
    got = {(r.doc_id, r.line_no): r.kept for r in fuzzy_lines.fuzzy_lines(steps(spark), frame).collect()}
    assert got == brute_lines(docs)


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))


ODD = ["", " ", "a  b", "a \n b\n\n  c ", " lead", "tab\t x   y  z", "<|endoftext|> a <|endoftext|>b", "it's 12,5 and  don't", "\x1c \x1d x", "é ü", "日本 語",
       "a" * 50 + " " + "b" * 3, "  two", "x \u3000 y", "end  ", "a'll 'll", "\u2028 x\u00a0 y"]


def test_ids_are_those_of_the_whole_text(tokenizer):
    texts = ODD + [r[1] for r in rows(FOLDER, "documents")]
    few = token_files.PieceIds(token_files.VOCABULARY, most=20)
    for n in range(0, 60, 6):  # forgets the older half again and again
        few.learn({f" w{k}" for k in range(n, n + 9)})
        assert all(few[f" w{k}"] == np.array(tokenizer.encode(f" w{k}", add_special_tokens=False).ids, "<u2").tobytes() for k in range(n, n + 9))
        assert len(few) <= 29
    assert list(token_files.encode([])) == []
    for t, ids in zip(texts, token_files.encode(texts)):
        assert tokenizer.encode(t, add_special_tokens=False).ids + [2] == ids.tolist(), repr(t[:50])


@pytest.mark.parametrize("ids", [[], [5], [7] * 1000, list(range(50)) * 40, [1, 2, 1, 2, 1] * 99])
def test_repair_round_trip(ids):
    ids = np.array(ids, np.uint16)
    rules, lengths, symbols = token_files.compress(ids, 50257)
    assert (token_files.expand(symbols, rules.astype(np.int64), 50257) == ids).all()
    assert lengths.sum() == sum(len(token_files.expand(np.array([50257 + i]), rules.astype(np.int64), 50257)) for i in range(len(rules)))
    assert len(ids) < 100 or len(symbols) < len(ids) / 4


def brute_tokens(docs, tokenizer):
    out, start = [], 0
    for i, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_token_files(spark, documents, tokenizer):
    docs = [(n * 7 % 40, t) for n, t in enumerate(ODD + [None, "word " * 5000])] + [(None, "no id"), (0, ""), (0, "")]
    ws = steps(spark)
    frame = documents([t for _, t in docs], ids=[i for i, _ in docs])
    shards = token_files.write_shards(ws, frame, ws.path("t"), block_ids=512)
    assert sorted((tuple(r)[:4] for r in token_files.read_shards(shards).collect()), key=str) == brute_tokens(docs, tokenizer)
    empty = token_files.write_shards(ws, documents([]), ws.path("none"))
    assert token_files.read_shards(empty).count() == 0


def test_token_files_on_the_tables(spark, tokenizer):
    docs = [(r[0], r[1]) for r in rows(FOLDER, "documents")]
    assert sorted((tuple(r) for r in QUERIES["op9_repair_token_files"](spark, FOLDER).collect()), key=str) == brute_tokens(docs, tokenizer)


def test_random_access(spark, documents):
    texts = [" ".join(prose(300, n)) for n in range(5)]
    ws = steps(spark)
    shard = token_files.write_shards(ws, documents(texts), ws.path("t"), block_ids=700).first()
    system, name = warc.opened(shard.path)
    with system.open_input_file(name) as source:
        opened = token_files.Shard(source, token_files.first_symbol_of(token_files.VOCABULARY))
        total = int(opened.documents[:, 2].sum())
        whole = opened.ids(0, total)
        assert len(whole) == total
        for a, n in ((0, 1), (699, 2), (5, 1500), (total - 1, 1), (total // 2, 0)):
            assert (opened.ids(a, n) == whole[a : a + n]).all()


def test_mixing(spark, documents):
    r = random.Random(5)
    texts = [" ".join(["w"] * r.randrange(0, 60)) for _ in range(900)] + [None, ""]
    sources = [r.choice(["b", "a", "c", "c", "c", "Z", "é"]) for _ in range(900)] + [None, "empty"]
    frame = documents(texts, source=sources)
    got = mixing.mixed_sources(steps(spark), frame).collect()
    again = mixing.mixed_sources(steps(spark), frame).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    sizes = Counter()
    for t, s in zip(texts, sources):
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(order)}
    target, left, open_now = {}, 1.5 * sum(sizes.values()), list(order)
    while True:
        shares = {s: left * weight[s] / sum(weight[x] for x in open_now) for s in open_now}
        full = [s for s in open_now if shares[s] > 2 * sizes[s]]
        if not full:
            target |= shares
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_now.remove(s)
        if not open_now:
            break
    taken = Counter()
    for row in got:
        assert row.target == pytest.approx(target[row.source]) and row.source_size == sizes[row.source]
        assert row.taken <= 2 * row.size
        taken[row.source] += row.taken
    assert len(got) == len(texts) and all(abs(taken[s] - target[s]) <= 130 for s in order)
    assert mixing.mixed_sources(steps(spark), documents([], source=[])).count() == 0


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_statement(name, spark):
    from check import connect, difference

    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), STATEMENTS[name]) is None


def test_decontamination_finds_through_the_latent_space(spark, documents, monkeypatch):
    """every verdict comes through the space. It is cut where passages are alike, which loses none; without it nothing is found."""
    items = [" ".join(prose(30, 60 + n)) for n in range(6)]
    items += [" ".join(words(i)[:-1] + [f"end{n}"]) for n, i in enumerate(items)]
    texts = [" ".join(prose(50, 200 + n) + words(i)[n % 6 :] + prose(30, 400 + n)) for n, i in enumerate(items)]
    texts += [" ".join(prose(100, 600 + n)) for n in range(100)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = lambda: {r.doc_id: r.item_ids for r in latent_decontamination.contaminated(steps(spark), documents(texts), bench).collect() if r.contaminated}
    ranks, whole = [], latent_decontamination.latent_space
    monkeypatch.setattr(latent_decontamination, "latent_space", lambda *a: ranks.append((s := whole(*a)).shape[1]) or s)
    monkeypatch.setattr(latent_decontamination, "CUT", 0.2)
    assert found() == {n: [n % 6, n % 6 + 6] for n in range(12)} and ranks[-1] < 12
    monkeypatch.setattr(latent_decontamination, "latent_space", lambda *a: whole(*a) * 0)
    assert not found()


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_pairs_ruled_out_by_bits_are_not_alike(threshold):
    rng = np.random.default_rng(5)
    lines = ["", "a", "abcde", "abcdef", "é" * 40, "日本語" * 9] + ["".join(rng.choice(list("abcdé "), n)) for n in rng.integers(1, 400, 40)]
    lines += [line[: len(line) // 2] + "x" + line[len(line) // 2 :] for line in lines] + [line * 30 for line in lines[:4]]
    one, two = (x.ravel() for x in np.meshgrid(np.arange(len(lines)), np.arange(len(lines))))
    may = fuzzy_lines.can_be_alike(lines, one, two, threshold)
    are = np.array([line_jaccard(lines[a], lines[b]) >= threshold for a, b in zip(one, two)])
    assert not (are & ~may).any()
    assert may.sum() < len(one) / 4


def test_bands_of_lines_are_gone_before_lines_are_compared(spark, documents, monkeypatch):
    words = prose(30, 3)
    frame = documents(["\n".join(" ".join(words[:i] + ["odd"] + words[i:]) for i in range(4)), " ".join(words)])
    ws, dropped, compare = steps(spark), [], fuzzy_lines.alike
    monkeypatch.setattr(ws, "drop", lambda name, drop=ws.drop: (dropped.append(name), drop(name)))
    monkeypatch.setattr(fuzzy_lines, "alike", lambda *a, **k: (dropped.append("compared"), compare(*a, **k))[1])
    got = fuzzy_lines.fuzzy_lines(ws, frame).collect()
    assert sum(r.kept for r in got) == 1 and len(got) == 5
    assert any(name.startswith("nodes") for name in dropped[: dropped.index("compared")])


def test_grams_are_counted_in_time_of_the_texts_alone(spark, documents, monkeypatch):
    counts = toxicity.gram_counts(documents(["ab"] * 30 + [None, ""]))
    at = lambda *s: ((s[0] * 32 + s[1]) * 32 + s[2]) * 32 + s[3]
    assert counts[at(0, 0, 0, 1)] == counts[at(0, 0, 1, 2)] == counts[at(0, 1, 2, 0)] == 30 and counts.sum() == 90
    taken = []
    monkeypatch.setattr(toxicity, "in_batches", lambda df, work, schema: taken.append(work) or spark.range(0).selectExpr("id AS gram", "id AS n"))
    toxicity.gram_counts(documents([]))
    batch, began = pa.RecordBatch.from_arrays([pa.array(["ab"] * 5000)], ["text"]), time.thread_time()
    assert len(list(taken[0](iter([batch])))[0]) == 3
    assert time.thread_time() - began < 1  # a pass over the million counts for every text takes several seconds


def test_new_pieces_go_to_the_model_by_word(tokenizer, monkeypatch):
    pieces = [" über", "x.\nThen,", " a-b", " don't", " 12,5", "\n", " end\n", " a\n\nb", " <|endoftext|>", "é...\né"]
    known, calls = token_files.PieceIds(token_files.VOCABULARY), []
    known.tokenizer = type("", (), {"encode_batch_fast": lambda self, some, **k: (calls.extend(some), tokenizer.encode_batch_fast(some, **k))[1]})()
    known.learn(pieces)
    assert all(known[p] == np.array(tokenizer.encode(p, add_special_tokens=False).ids, "<u2").tobytes() for p in pieces)
    assert not {" über", "x.\nThen,", "é...\né"} & set(calls)


def test_components_take_no_job_to_compare_rounds(spark, monkeypatch):
    frame = spark.createDataFrame([(i, i + 1) for i in range(9)] + [(20, 21), (5, 5)], "a long, b long")
    ws = steps(spark)

    def read(self):
        raise AssertionError("the edges are read for their number")

    with monkeypatch.context() as m:
        m.setattr(type(frame), "first", read)
        found = components(ws, frame)
        none = components(ws, frame.where("a > 99"))
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(10)} | {(20, 20), (21, 20)}
    assert none.count() == 0


def test_plain_words_are_encoded_by_the_thousand_and_their_parts_once(tokenizer):
    def ids(piece):
        return tokenizer.encode(piece, add_special_tokens=False).ids

    pieces, calls = token_files.PieceIds(token_files.VOCABULARY), []
    known = token_files.PartIds(pieces, most=8)
    known.words = type("", (dict,), {"__missing__": lambda self, part: (calls.append(part), pieces.words[part])[1]})()
    for words in (["tone", "tone.", "über,\nThen;", "a\nb"], [], ["tone\ntone", "éa"], ["zz", "tone!?"], ["x"]):  # forgets what it held once
        flat, sizes = known.of_plain(pa.array(words, pa.string()))
        ends = np.cumsum(sizes)
        assert [flat[e - n : e].tolist() for e, n in zip(ends, sizes)] == [ids(f" {w}") for w in words]
    assert not [part for part in calls if part.startswith(" ")] and len(known.parts) <= 8


def test_later_rounds_of_links_start_from_stars(spark, monkeypatch):
    sets = {i: list(range(i * 100, i * 100 + 10)) for i in range(4)} | {i + 4: list(range(i * 100, i * 100 + 9)) for i in range(4)}
    elements = spark.createDataFrame(list(sets.items()), "node long, e array<long>")
    banded = spark.createDataFrame([(1, i, len(e)) for i, e in sets.items()], "band long, node long, n int")
    given, whole = [], similar.components
    monkeypatch.setattr(similar, "components", lambda ws, edges: (given.append(edges), whole(ws, edges))[1])
    found = similar.similar_components(steps(spark), banded, lambda wanted: elements.join(wanted, "node"), 0.8)
    assert {r.node: r.component for r in found.collect()} == {i: i % 4 for i in sets}
    assert len(given) == 2 and given[0].distinct().count() < given[1].distinct().count() == 4
