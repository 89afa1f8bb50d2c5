"""Operators of the training-data subpackage against brute force, on small inputs with odd rows."""

import collections
import math
import os
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roomtide.llm import (bpe, components, decontamination, hmm, hnsw, jaccard, language, queries, sharding, surrogates,
                          tokenfiles, toxicity, words)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _rank string, token string"
TOKENIZERS = queries.TOKENIZERS
ASCII = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(ASCII))


def vocabulary(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def rows(seed=1):
    """Random texts, near and exact copies, and null, empty, blank, short, long and repeated ones."""
    rng = random.Random(seed)
    known = vocabulary(rng, 300)
    out = []
    for i in range(40):
        text = [rng.choice(known) for _ in range(rng.randint(10, 60))]
        out.append((i, " ".join(text)))
        for copy in range(rng.randint(0, 3)):
            other = list(text)
            for _ in range(copy):
                other[rng.randrange(len(other))] = "changed"
            out.append((100 + 10 * i + copy, "\n".join(other).upper()))
    out += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "One"), (1004, "one"), (1005, "two words"),
            (1006, " ".join(rng.choice(known) for _ in range(5000))), (1007, "x " * 3000), (1008, "a\xa0b\x85c é"),
            (None, "text without id"), (1, out[0][1])]
    out.append(out[3])
    return out


def table(spark, data):
    return spark.createDataFrame([(i, t, "en", "s", 0, "clash", "clash") for i, t in data], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, rows()).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, [])


# Words

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x85é\x1c𝔸", max_size=12)), max_size=6))
def test_words_equal_the_pattern(texts):
    found = words.words_of(pa.array(texts, pa.string()), words.Hasher())
    for d, text in enumerate(texts):
        own = [found.word(i) for i in range(found.first[d], found.first[d + 1])]
        assert own == tokens(text)
    hashes = {found.word(i): int(found.hashes[i]) for i in range(len(found.hashes))}
    assert all(hashes[found.word(i)] == found.hashes[i] for i in range(len(found.hashes)))
    assert len(set(hashes.values())) == len(hashes)


# 1 surrogates

PRIVATE = [
    (1, "Write to Bob.Smith@Foo.com, not bob.smith@foo.com. Mr. John Smith met Mrs. SMITH."),
    (2, "Call +1 (456) 555-2186 or 456-555-2186; card 4111 1111 1111 1111 = 4111111111111111"),
    (3, "ip 10.0.0.255, ssn 123-45-6789, password=abc123def, token = \"deadbeef00112233\""),
    (4, "Version 2.0, 1999, 12345, @home, Herr, v1.2.3.4.5"), (5, None), (6, ""), (7, "Господин Иванов и Госпожа Иванов")]


def luhn(digits):
    marks = [int(c) for c in reversed(digits)]
    return sum(m if i % 2 == 0 else sum(divmod(2 * m, 10)) for i, m in enumerate(marks)) % 10 == 0


def test_surrogates_keep_type_format_and_coreference(spark):
    out = {r.doc_id: r for r in surrogates.replaced(table(spark, PRIVATE)).collect()}
    assert out[4].text == PRIVATE[3][1] and out[4].n_entities == 0
    assert out[5].text is None and out[6].text == "" and out[1]._rank == "clash"
    first, second = re.findall(r"\S+@[\w.]+", out[1].text)
    assert first.lower() == second.rstrip(".") or first.lower() == second
    assert first[0].isupper() and "smith" not in out[1].text.lower()
    given_name, surname, again = re.search(r"Mr\. (\w+) (\w+) met Mrs\. (\w+)\.", out[1].text).groups()
    assert surname.upper() == again and not given_name.endswith("a")
    phones = re.search(r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4})", out[2].text).groups()
    assert phones[:3] == phones[3:] != ("456", "555", "2186")
    spaced, plain = re.search(r"card (\d{4} \d{4} \d{4} \d{4}) = (\d{16})", out[2].text).groups()
    assert spaced.replace(" ", "") == plain != "4" + "1" * 15 and plain[0] == "4" and luhn(plain)
    octets = re.search(r"ip (\d+)\.(\d+)\.(\d+)\.(\d+),", out[3].text).groups()
    assert all(0 <= int(o) <= 255 for o in octets)
    assert re.search(r"ssn \d{3}-\d{2}-\d{4}, password=[a-f]{3}\d{3}[a-f]{3}, token = \"[a-f]{8}\d{8}\"", out[3].text)
    names = re.search(r"Господин (\w+) и Госпожа (\w+)", out[7].text).groups()
    assert names[0] == names[1] != "Иванов" and re.fullmatch("[а-яА-Я]+", names[0])


def test_secrets_after_keys_in_any_case(spark):
    secrets = {1: 'TOKEN = "9233ABFFECDE"', 2: "PASSWORD=hunterTwo", 3: "see Secret: qwertyZ", 4: "API_KEY='abcDEFgh'", 5: "Passwd = xyzxyzxyz",
               6: "token=abcDEFgh"}
    out = {r.doc_id: r for r in surrogates.replaced(table(spark, [*secrets.items(), (9, "TOKENS = abcdefgh")])).collect()}
    for i, text in secrets.items():
        key, value = re.fullmatch(r"(.*[=:] ?[\"']?)(\w+)([\"']?)", text).group(1, 2)
        assert out[i].text.startswith(key) and value not in out[i].text and out[i].n_entities == 1 and len(out[i].text) == len(text)
    assert out[4].text[9:-1] == out[6].text[6:] and out[9].n_entities == 0


def test_telephone_numbers_in_groups_of_any_size(spark):
    phones = ["+45 12 34 56 78", "+47 22-33-44-55", "+33 1 23 45 67 89", "555 123 4567", "+49 30 12 34 56 78", "+4512345678", "+12 34 56",
              "+1 555 123 4567", "(456) 555-2186", "456-555.2186", "+1 456-555-2186", "+123 1234 1234 1234 1234"]
    mixed = ["a@b.cd", "TOKEN=abcdef", "10.0.0.1", "1.2.3.4", "4111 1111 1111 1111", "123-45-6789", "Mme Curie", "Señora Paz", "Miss Poe"]
    no = ["+1 2 3 4", "1 + 2", "12 34 56 78", "a+45 12 34 56 78", "100 200", "5555 123 4567", "+1 2 3 4 5 6x", "555 1234567"]
    data = [*enumerate(phones), *enumerate([f"in 2024, {p}." for p in phones], 100), *enumerate(mixed, 200), *enumerate(no, 300)]
    frame = table(spark, data)
    out = {r.doc_id: r for r in surrogates.replaced(frame).collect()}
    for i, phone in enumerate(phones):
        assert out[i].n_entities == out[100 + i].n_entities == 1
        assert out[100 + i].text == f"in 2024, {out[i].text}." and out[i].text != phone
        assert re.sub(r"\d", "9", out[i].text) == re.sub(r"\d", "9", phone) and out[i].text[-2:] != phone[-2:]
    assert out[0].text.replace(" ", "") == out[5].text
    assert all(out[300 + i].text == t and not out[300 + i].n_entities for i, t in enumerate(no))
    # Every text with a mention passes the prefilter.
    missed = frame.where(F.size(F.regexp_extract_all("text", F.lit(surrogates._ANY), F.lit(0))) > 0).where(~surrogates._hinted(F.col("text")))
    assert missed.count() == 0 and all(out[200 + i].n_entities for i in range(len(mixed)))


def test_colliding_surrogates_are_drawn_again(spark):
    data = [(i, f"call 200-200-{i:04d} or 10.0.0.{i % 256}") for i in range(600)]
    data += [(9000 + i, f"x{i}.y@a.bc") for i in range(30)] + [
        (9100 + i, f"{c}@{d}.bc") for i, (c, d) in enumerate((c, d) for c in "abcdefghijklmnopqrstuvwxyz" for d in "abcd")]
    frame = table(spark, data)
    made = surrogates.attempts(surrogates.entities(frame), "k").collect()
    for kind in {r.kind for r in made}:
        own = [r for r in made if r.kind == kind]
        assert len({r.made for r in own}) == len(own)
        assert not {r.made for r in own} & {r.canon for r in own}
    assert any(r.attempt for r in made)
    expected = {r.canon: r.made for r in made if r.kind == "email"}
    out = {r.doc_id: r.text for r in surrogates.replaced(frame, "k").collect()}
    assert all(out[i] == expected[t] for i, t in data if t in expected)


# 2 sharding

def test_shards_are_a_gapless_permutation(documents):
    out = sharding.shard(documents, 8).collect()
    n = len(out)
    assert sorted(r.position for r in out) == list(range(n)) == sorted(r.row_number for r in out)
    sizes = collections.Counter(r.shard for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    for r in out:
        assert (r.shard, r.slot) == (r.position % 8, r.position // 8)
    facts = {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows()}
    assert {(r.doc_id, r.size, r.text_crc32) for r in out} == facts
    again = sharding.shard(documents.repartition(5), 8).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000])
def test_permutation_is_one_to_one(spark, n):
    out = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, "k")).collect()]
    assert sorted(out) == list(range(n)) and (n < 64 or out != sorted(out))


# 3 language model

def test_base_score_counts_and_likelihood(spark, documents):
    data = [(i, t) for i, t in rows()]
    out = hmm.score(documents, queries.remainder("doc_id", 10) == 0).collect()
    assert len(out) == len(data)
    count = collections.Counter()
    for i, t in data:
        if zlib.crc32(str("" if i is None else i).encode()) % 10:
            count.update([*tokens(t), None])
    total, distinct = sum(count.values()), len(count)
    want = collections.Counter()
    for i, t in data:
        own = [*tokens(t), None]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        want[i, len(own), sum(count[w] > 0 for w in own), round(base, 5)] += 1
    assert want == collections.Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in out)
    assert {r.train_tokens for r in out} == {total} and all(r.score < 0 for r in out)


def test_forward_equals_a_sum_over_paths_and_baum_welch_climbs():
    rng = np.random.default_rng(0)
    emit = rng.random((hmm.STATES, 9))
    move = rng.random((hmm.STATES, hmm.STATES))
    model = hmm.Model(np.full(hmm.STATES, 1 / hmm.STATES), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))
    own = [rng.integers(0, 9, size) for size in (1, 3, 4)]

    def paths(s):
        total = 0.0
        for states in np.ndindex(*[hmm.STATES] * len(s)):
            p = model.start[states[0]] * model.emit[states[0], s[0]]
            for a, b, o in zip(states, states[1:], s[1:]):
                p *= model.move[a, b] * model.emit[b, o]
            total += p
        return math.log10(total)

    assert np.allclose(model.log10(own), [paths(s) for s in own])
    long = [rng.choice(9, 60, p=p) for p in np.eye(9)[:6] * 0.9 + 0.1 / 9 for _ in range(5) if abs(p.sum() - 1) < 1e-9]
    flat, sizes = np.concatenate(long), np.array([len(s) for s in long])
    totals = np.bincount(flat, minlength=9).astype(float)
    before = model.log10(long).sum()
    for _ in range(4):
        counts = model.expected(flat, np.cumsum(sizes) - sizes, sizes)
        assert np.isclose(counts[:hmm.STATES].sum(), len(long))
        assert np.isclose(counts[hmm.STATES + hmm.STATES ** 2:].sum(), len(flat))
        model = hmm.Model.learned(counts, totals)
    assert model.log10(long).sum() > before


# 4 BPE

@pytest.fixture(scope="module")
def tokenizer():
    return bpe.Tokenizer(f"{TOKENIZERS}/word_bpe_49k.json")


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="aelnrt 's<|>", max_size=40),
                 st.lists(st.sampled_from(["<|endoftext|>", "Hello", " ", "llllll", "ΑΣ", "İ", "\x1c", "ﬁ", "12"]), max_size=6).map("".join)))
def test_bpe_equals_the_library(tokenizer, text):
    from tokenizers import Tokenizer

    library = test_bpe_equals_the_library.__dict__.setdefault("library", Tokenizer.from_file(f"{TOKENIZERS}/word_bpe_49k.json"))
    ids = library.encode(text, add_special_tokens=False).ids
    encoder = bpe.Tokenizer.encoder(test_bpe_equals_the_library.__dict__.setdefault("parts", tokenizer.parts()))
    line = encoder.encode(text)
    assert line == " ".join(map(str, ids))
    assert encoder.decode(line) == library.decode(ids, skip_special_tokens=False)


def test_automaton_allows_exactly_merged_sequences():
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "a"), ("ab", "ab")]
    made = {u + v for u, v in merges}
    automaton = bpe.Automaton({w: i for i, w in enumerate(["a", "b", *sorted(made)])}, merges, "")

    def merged(text):
        out = list(text)
        for u, v in merges:
            i = 0
            while i < len(out) - 1:
                if (out[i], out[i + 1]) == (u, v):
                    out[i:i + 2] = [u + v]
                i += 1
        return out

    for n in range(1, 10):
        for bits in range(2 ** n):
            text = "".join("ab"[bits >> i & 1] for i in range(n))
            assert automaton.path(text) == merged(text)


def test_bpe_of_odd_rows(documents, nothing):
    out = bpe.encode(documents, f"{TOKENIZERS}/word_bpe_49k.json", texts=True)
    by = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows()) and by[1000].n_tokens == by[1001].n_tokens == 0 and by[1001].decoded == ""
    assert by[1007].ids == by[1007].ids[:1] * 3000 and by[0]._rank == "clash"
    assert bpe.encode(nothing, f"{TOKENIZERS}/word_bpe_49k.json").count() == 0


# 5 decontamination

def test_containment_equals_brute_force(spark, documents, nothing):
    rng = random.Random(4)
    base = [t for _, t in rows() if t and len(t.split()) > 20]
    items = []
    for i in range(25):
        own = tokens(rng.choice(base))
        own = own[:rng.randint(6, 30)]
        for _ in range(i % 4):
            own[rng.randrange(len(own))] = "other"
        items.append((i, " ".join(own)))
    items += [(100, None), (101, ""), (102, "two words"), (103, "missing pair"), (104, items[0][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def shingles(own, n):
        return {tuple(own[k:k + n]) for k in range(len(own) - n + 1)}

    want = set()
    for item, text in items:
        own = tokens(text)
        n = min(5, len(own))
        for doc, t in rows():
            if n and 10 * len(shingles(own, n) & shingles(tokens(t), n)) >= 8 * len(shingles(own, n)):
                want.add((doc, item))
    got = [(r.doc_id, r.item_id) for r in decontamination.contaminated(documents, benchmark).collect()]
    assert set(got) == want and len(want) > 20
    kept = decontamination.clean(documents, benchmark)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows()} - {d for d, _ in want}
    assert decontamination.contaminated(nothing, benchmark).count() == 0
    assert decontamination.clean(documents, benchmark.limit(0)).count() == len(rows())


def test_contamination_in_upper_cased_copies_of_any_script(spark):
    texts = ["el niño pequeño comió una manzana después", "мальчик съел яблоко после обеда дома", "çà et là où l'été était"]
    data = [(i, f"before {t.upper()} after") for i, t in enumerate(texts)] + [(9, "el nino pequeno comio una manzana despues")]
    benchmark = spark.createDataFrame([*enumerate(texts), (7, texts[0].upper())], "item_id long, text string")
    found = decontamination.contaminated(table(spark, data), benchmark).collect()
    assert {(r.doc_id, r.item_id, r.containment) for r in found} == {(0, 0, 1), (1, 1, 1), (2, 2, 1), (0, 7, 1)}
    assert [r.doc_id for r in decontamination.clean(table(spark, data), benchmark).collect()] == [9]


# 6 toxicity

def test_network_learns_marks_and_stems(spark):
    rng = random.Random(3)
    known = vocabulary(rng, 400)
    data, labels = [], []
    for i in range(260):
        text = [rng.choice(known) for _ in range(rng.randint(20, 90))]
        if i % 3 == 0:
            text[rng.randrange(len(text))] = rng.choice(["zzidiot", "zzscum", "qqv" + rng.choice(known)])
        data.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 3 == 0)))
    data += [(900, None), (901, ""), (902, "   "), (903, "word " * 5000 + "zzidiot")]
    labels += [(0, 1, 0), (5000, 1, 1), (1, 1, None)]
    documents = table(spark, data)
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.classify(documents, marked, queries.remainder("doc_id", 3) == 1).collect()}
    held = [i for i in range(260) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum(out[i].predicted == int(i % 3 == 0) for i in held)
    assert right >= 0.9 * len(held) and out[903].predicted == 1 and out[903].windows > 100
    assert [out[i].score for i in (900, 901, 902)] == [0, 0, 0] and all(0 <= r.score <= 1 for r in out.values())
    none = toxicity.classify(documents, marked.limit(0), F.lit(False)).collect()
    assert {r.predicted for r in none} == {0} and len(none) == len(data)


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    network = toxicity.Network()
    network.p = {k: v.astype(float) for k, v in network.p.items()}
    slots = rng.integers(0, 40, (7, 6))
    slots[-1] = 0
    rows_ = rng.integers(0, 6, (4, toxicity.LENGTH))
    rows_[2, 9:] = 6
    y = np.array([0, 1, 1, 0])
    g = network.gradient(slots, rows_, y)

    def loss():
        z = network.forward(slots, rows_)
        return np.mean(np.logaddexp(0, z) - y * z)

    for name, at in [("word", (slots[0, 0], 2)), ("gram", (slots[1, 2], 3)), ("wf", (2, 5)), ("ub", (3, 20)), ("a", (4, 2)), ("v", (1,)), ("o", (9,))]:
        kept = network.p[name][at]
        values = []
        for step in (1e-4, -1e-4):
            network.p[name][at] = kept + step
            values.append(loss())
        network.p[name][at] = kept
        assert np.isclose((values[0] - values[1]) / 2e-4, g[name][at], rtol=2e-3, atol=1e-6)


# 7 token files

@pytest.mark.parametrize("block", [10, 1000])
def test_counts_by_separator_scan(spark, tmp_path, block):
    rng = random.Random(block)
    want, sizes = {}, []
    for f in range(3):
        lengths = [rng.choice([0, 0, 1, 3, 4, 5, 40]) for _ in range(30)]
        ids = []
        for n in lengths:
            ids += [rng.randrange(5) for _ in range(n)] + [9]
        if f == 1:
            ids += [1, 2, 3]
        path = tmp_path / f"{f}.tokens"
        path.write_bytes(np.array(ids, "<u2").tobytes())
        sizes.append((f"file://{path}", path.stat().st_size))
        want |= {(f"file://{path}", i): (n, True) for i, n in enumerate(lengths)}
        if f == 1:
            want[f"file://{path}", 30] = (3, False)
    (tmp_path / "empty.tokens").write_bytes(b"")
    sizes.append((f"file://{tmp_path}/empty.tokens", 0))
    files = spark.createDataFrame(sizes, "file string, size long")
    out = tokenfiles.scan(files, 9, block).collect()
    assert {(r.file, r.ordinal): (r.n_tokens, r.finished) for r in out} == want and len(out) == len(want)


def test_counts_equal_the_tokenizer(documents, nothing):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    out = tokenfiles.counts(documents, f"{TOKENIZERS}/byte_bpe_50k.json").collect()
    want = sorted((-1 if i is None else i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in out) == want
    assert tokenfiles.counts(nothing, f"{TOKENIZERS}/byte_bpe_50k.json").count() == 0


# 8 Jaccard join

def linked(data, n, percent):
    """(doc_id, set size, smallest doc_id of the component) of every row, by all pairs."""
    sets = []
    for _, t in data:
        own = tokens(t)
        sets.append(frozenset(tuple(own[k:k + min(n, len(own))]) for k in range(max(1, len(own) - n + 1))) if own else frozenset())
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(data):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return collections.Counter((doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(data))


@pytest.mark.parametrize(("n", "percent", "hot"), [(4, 85, 256), (4, 85, 3), (5, 80, 3)])
def test_components_equal_all_pairs(spark, documents, monkeypatch, n, percent, hot):
    monkeypatch.setattr(jaccard, "HOT", hot)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    near = []
    for i in range(24):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(60)] = f"v{rng.randrange(40)}"
        near.append((5000 + i, " ".join(own)))
    data = rows() + near
    out = jaccard.groups(documents.unionByName(table(spark, near)), n, percent).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in out) == linked(data, n, percent)


def test_jaccard_of_empty_table_and_deduplication(documents, nothing):
    assert jaccard.groups(nothing).count() == 0
    want = {d for d, n, c in linked(rows(), 5, 80) if d == c or not n}
    kept = jaccard.deduplicated(documents)
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == documents.columns


def test_deduplication_keeps_one_row_of_each_group(spark, documents):
    own = {c: " ".join(f"{c}{i}" for i in range(30)) for c in "abcdef"}
    near = own["d"] + " end"
    data = [(1, own["a"]), (1, own["a"]), (1, own["b"]), (0, own["b"]), (1, own["c"]), (1, own["c"] + " "), (2, own["a"]),
            (None, own["d"]), (None, own["d"]), (None, near), (None, own["e"]), (7, own["e"]), (None, own["f"]),
            (None, ""), (None, ""), (None, None), (1, " "), (3, "")]
    out = collections.Counter((r.doc_id, (r.text or "").strip()[:2]) for r in jaccard.deduplicated(table(spark, data).repartition(3)).collect())
    assert out == {(1, "a0"): 1, (0, "b0"): 1, (1, "c0"): 1, (None, "d0"): 1, (7, "e0"): 1, (None, "f0"): 1, (None, ""): 3, (1, ""): 1, (3, ""): 1}
    # A third of the rows under one id, another third without any; each group leaves one row.
    mixed = documents.withColumn("doc_id", F.when(F.crc32("text") % 3 == 0, 5).when(F.crc32("text") % 3 == 1, None).otherwise(F.col("doc_id")))
    found = jaccard.groups(documents)
    blank = sum(not tokens(t) for _, t in rows())
    groups_ = len({r.root for r in jaccard._rooted(documents, 5, 80).collect() if r.root is not None})
    assert jaccard.deduplicated(mixed).count() == groups_ + blank == jaccard.deduplicated(documents).count()
    assert found.count() == len(rows()) > groups_ + blank


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    out = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


# 9 language

def test_languages_of_held_out_texts(spark):
    rng = random.Random(2)
    parts = {"aa": ["the", "ing", "tion", "er", "on"], "bb": ["ée", "eau", "que", "oi", "ai"], "cc": ["ung", "sch", "pf", "ei", "tz"]}
    data = []
    for i in range(240):
        lang = sorted(parts)[i % 3]
        text = " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 900)))
        data.append((i, text, lang))
    data += [(900, None, "aa"), (901, "", "aa"), (902, "12 !?", "bb"), (903, "the tion", None), (904, "ππππ", None)]
    frame = spark.createDataFrame([(*d, "s", "clash") for d in data], "doc_id long, text string, lang string, source string, score string")
    out = {r.doc_id: r for r in language.identify(frame, queries.remainder("doc_id", 3) == 1).collect()}
    assert all(out[i].lang_pred == lang for i, _, lang in data[:240]) and out[903].lang_pred == "aa"
    assert {(out[i].lang_pred, out[i].score) for i in (900, 901, 902)} == {("und", 0.0)}
    assert out[904].lang_pred in parts and all(0 <= r.score <= 1 for r in out.values())
    none = language.identify(frame.withColumn("lang", F.lit(None).cast("string")), F.lit(False)).collect()
    assert {r.lang_pred for r in none} == {"und"} and len(none) == len(data)


# 10 nearest neighbours

def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((3000, 12)) * rng.uniform(0.5, 2, (3000, 1))
    vectors[100:400] = vectors[100]
    data = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    odd = [(9000, None), (9020, []), (9040, [0.0] * 12), (9060, [float("nan")] + [1.0] * 11), (9080, [None] + [1.0] * 11), (9100, [1.0, 2.0]), (9120, [2.0, 1.0]), (9101, [1.0, 0.0])]
    frame = spark.createDataFrame([(*d, "clash") for d in data + odd], "vec_id long, embedding array<float>, shard string")
    out = collections.defaultdict(list)
    for r in hnsw.neighbours(frame).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(out) == {i for i in range(0, 3000, 20)} | {9100, 9120}
    assert [v for _, v, _ in out[9100]] == [9120, 9101] and [v for _, v, _ in out[9120]] == [9100, 9101]
    exact = np.array([d[1] for d in data], np.float64)
    hits = 0
    for q in range(0, 3000, 20):
        scores = exact @ exact[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -scores))[:20]
        got = [v for _, v, _ in out[q]]
        assert len(got) == 20 == len(set(got)) and q not in got and [r for r, _, _ in out[q]] == list(range(1, 21))
        assert np.allclose([s for _, _, s in out[q]], scores[got], rtol=1e-12)
        hits += len(set(got) & set(best.tolist()))
    assert hits >= 0.95 * 20 * 150
    assert hnsw.neighbours(frame.limit(0)).count() == 0


# Every operator

def test_bpe_equals_the_library_on_every_code_point(tokenizer):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(f"{TOKENIZERS}/word_bpe_49k.json")
    encoder = bpe.Tokenizer.encoder(tokenizer.parts())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 50_000):
        texts = [f":{chr(c)}a" for c in points[at:at + 50_000]]
        for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
            assert encoder.encode(text) == " ".join(map(str, found.ids)), ascii(text)
        encoder.clear()


def test_long_words_are_not_kept(tokenizer):
    encoder = bpe.Tokenizer.encoder(tokenizer.parts())
    encoder.encode("short " + "x" * 5000)
    assert set(encoder) == {"short"}


def test_samples_are_the_lowest_hashes(spark):
    from roomtide.llm import samples

    rows = [(label, (i * 0x9E3779B97F4A7C15) % 2 ** 64 - 2 ** 63) for label, n in (("a", 5000), ("b", 40), ("c", 3)) for i in range(n)]
    found = samples.lowest(spark.createDataFrame(rows * 2, "label string, hash long"), 30)
    own = {label: sorted(r.hash for r in found if r.label == label) for label in "abc"}
    assert own == {label: sorted(h for a, h in rows if a == label)[:30] for label in "abc"}
    # Hashes that all lie high pass no first bound.
    high = [("d", 2 ** 63 - 1 - i) for i in range(2000)]
    assert {r.hash for r in samples.lowest(spark.createDataFrame(high, "label string, hash long"), 5)} == {2 ** 63 - 2000 + k for k in range(5)}
    assert samples.lowest(spark.createDataFrame([], "label string, hash long"), 5) == []


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Every operator and the pipeline, with workers that cannot import the repository."""
    import os
    import subprocess
    import sys
    import textwrap

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(f"""
        import importlib.util, os, sys
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").config("spark.driver.memory", "3g").getOrCreate())
        sys.path.insert(0, {repo!r})  # after the session: workers do not get it
        spec = importlib.util.spec_from_file_location("__spark_entry__", {repo!r} + "/__spark_entry__.py")
        driver = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(driver)
        seen = spark.sparkContext.parallelize([0], 1).map(lambda _: [p for p in __import__("sys").path]).first()
        assert {repo!r} not in seen, seen
        folder = sys.argv[1]
        for name, query in driver.queries().items():
            if name.startswith("op") and name[2].isdigit() or name in ("pipeline", "rollout", "lr_l1"):
                print(name, query(spark, folder).count(), flush=True)
    """))
    out = subprocess.run([sys.executable, str(script), "/root/testdata/sf0.001"], cwd=tmp_path, capture_output=True, text=True,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    assert len(out.stdout.split("\n")) >= 16


def test_names_in_every_spelling(spark):
    names = ["Mr. J. Smith", "MR JOHN SMITH", "Mr  John Smith", "Mr.\nJohn Smith", "Mr\u00a0John Smith", "Dr. John Smith", "Prof. Ada M. Lovelace",
             "Mr John Michael Peter Smith", "Mrs. Anne-Marie van der Berg", "Herr O'Neill", "DR. JOSÉ NIÑO", "Señora María de la Cruz",
             "Доктор Анна Иванова", "Mme \r\n Curie", "SRA. ANA", "Sr. Juan Pérez"]
    out = {r.doc_id: r for r in surrogates.replaced(table(spark, [(i, f"then {n}, who left.") for i, n in enumerate(names)])).collect()}
    real = {w.lower() for n in names for w in re.findall(r"\w{3,}", n)} - {"prof", "herr", "señora", "доктор", "mme", "sra", "mrs", "van", "der"}
    for i, name in enumerate(names):
        text = out[i].text
        assert out[i].n_entities == 1 and text.startswith("then ") and text.endswith(", who left."), (name, text)
        new = text[5:-11]
        assert not {w.lower() for w in re.findall(r"\w{3,}", new)} & real, (name, new)
        assert re.findall(r"\s+", new) == re.findall(r"\s+", name)
        assert [w.isupper() for w in new.split()] == [w.isupper() for w in name.split()]
    assert out[0].text[5:10].startswith("Mr. ") and re.fullmatch(r"Mr\. [A-Z]\. \w+", out[0].text[5:-11])
    surname = lambda i: out[i].text[5:-11].split()[-1].lower()
    assert surname(0) == surname(1) == surname(2) == surname(3) == surname(4) == surname(5) == surname(7)
    assert " van der " in out[8].text and " de la " in out[11].text
    clean = ["Dr. and nobody", "MR is a word", "the Sir said", "Mrs.", "Misses Smith", "Mrt Smith", "DROP TABLE X"]
    kept = {r.doc_id: r for r in surrogates.replaced(table(spark, list(enumerate(clean)))).collect()}
    assert all(kept[i].text == t and kept[i].n_entities == 0 for i, t in enumerate(clean))


def test_accented_addresses_and_ipv6(spark):
    texts = ["josé.niño@correo.es", "Иван.Петров@почта.рф", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "see fe80::1ff:fe23:4567:890a.", "x ::1, y",
             "12:34:56 std::vector a::b 1:2:3:4"]
    out = {r.doc_id: r for r in surrogates.replaced(table(spark, list(enumerate(texts)))).collect()}
    assert not set("éñ") & set(out[0].text) and re.fullmatch(r"[a-z]{4}\.[a-z]{4}@[a-z]{6}\.es", out[0].text)
    assert re.fullmatch(r"[А-Я][а-я]{3}\.[А-Я][а-я]{5}@[а-я]{5}\.рф", out[1].text) and "етров" not in out[1].text
    assert re.fullmatch(r"(?:[0-9a-f]{4}:){7}[0-9a-f]{4}", out[2].text) and out[2].text != texts[2]
    assert re.fullmatch(r"see [0-9a-f]{4}::[0-9a-f]{3}:[0-9a-f]{4}:\d{4}:[0-9a-f]{4}\.", out[3].text) and out[3].text != texts[3]
    assert [out[i].n_entities for i in range(6)] == [1, 1, 1, 1, 1, 0] and out[5].text == texts[5]


def test_a_hundred_thousand_names_stay_distinct(spark):
    found = spark.range(100_000).select(F.lit("given/male/latin").alias("kind"), F.concat(F.lit("n"), F.col("id")).alias("canon"))
    found = found.unionByName(spark.range(50).select(F.lit("email").alias("kind"), F.concat(F.lit("a@"), F.chr(97 + F.col("id") % 26), F.lit(".bc")).alias("canon")).distinct())
    row = surrogates.attempts(found, "k").where("kind <> 'email'").agg(
        F.count("*").alias("n"), F.countDistinct("made").alias("made"), F.count_if(F.col("made").contains("-")).alias("hashed"),
        F.max("attempt").alias("most")).first()
    assert (row.n, row.made, row.hashed) == (100_000, 100_000, 0) and row.most >= 1


CLASHING = ["_text", "_id", "_print", "_key", "_mentions", "_attempts", "_held", "_same", "_row", "_of", "_n", "_m", "_r", "_h", "copies",
            "class", "root", "hash", "print", "key", "score", "windows", "predicted", "n_entities", "n_tokens", "item", "item_id", "count",
            "label", "token", "part", "rank", "size", "shard", "slot", "rows", "u"]


def clashing(spark, data):
    """Documents with a column for every internal name of the operators."""
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def clash_table(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("clash"))
    data = [(i, t, "en" if (i or 0) % 2 else "de", "s", 3) for i, t in rows()[:60]] + [(None, None, None, None, None), (77, "", None, None, None)]
    clashing(spark, data).repartition(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(tokens(rows()[0][1])[:12])), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    empty = f"{folder}/empty"
    clashing(spark, []).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    return folder, len(data)


NAMES = [n for n in queries.QUERIES if n not in ("op10_small_world_neighbours", "op11_trie_codes")]


@pytest.mark.parametrize("name", NAMES)
def test_columns_with_internal_names_and_empty_tables(spark, clash_table, name):
    folder, n = clash_table
    found = queries.QUERIES[name](spark, folder)
    assert found.count() == n or name.startswith("op5_")
    assert queries.QUERIES[name](spark, f"{folder}/empty").count() == 0


def test_stages_pass_columns_with_internal_names(spark, clash_table):
    import corpus_pipeline

    folder, _ = clash_table
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, function in corpus_pipeline.STAGES[:4]:
        out = function(spark, docs, folder)
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert all(r[c] == (None if r.doc_id is None else f"{c} {r.doc_id}") for c in CLASHING), name
    assert "ids_sha256" in corpus_pipeline.STAGES[4][1](spark, docs, folder).columns


@pytest.mark.parametrize("hot", [256, 3])
@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_the_whole_join_loses_no_link(spark, documents, monkeypatch, hot, n, percent):
    """All pairs of different sets that link, with membership, against brute force."""
    monkeypatch.setattr(jaccard, "HOT", hot)
    rows_of, pairs = jaccard.joined(documents, n, percent)
    rows_of, pairs = rows_of.collect(), {tuple(sorted(r)) for r in pairs.collect()}

    def shingles(text):
        own = tokens(text)
        return frozenset(tuple(own[i:i + n]) for i in range(len(own) - n + 1)) if len(own) >= n else frozenset([tuple(own)] if own else [])

    sets = {shingles(t) for _, t in rows()} - {frozenset()}
    wanted = collections.Counter()
    number = 0
    for a in sets:
        for b in sets:
            if a is not b and 100 * len(a & b) >= percent * len(a | b):
                wanted[a] += 1
                number += 1
    assert 2 * len(pairs) == number > 0
    assert len({r["class"] for r in rows_of if r["class"] is not None}) == len(sets)
    found = sorted(((r.doc_id, r.n_shingles, r.links) for r in rows_of), key=repr)
    assert found == sorted(((i, len(shingles(t)), wanted[shingles(t)]) for i, t in rows()), key=repr)


def test_arcs_and_transitions_equal_merging_step_by_step(tokenizer):
    """Arcs join tokens that merging by rank leaves apart; every prefix has the last token that merging gives it."""
    import json

    automaton = tokenizer.automaton
    model = json.load(open(f"{TOKENIZERS}/word_bpe_49k.json", encoding="utf-8"))["model"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    rank = {(automaton.name[u], automaton.name[v]): k for k, (u, v) in enumerate(pairs) if u in automaton.name and v in automaton.name}

    def merged(symbols):
        while True:
            found = min(((rank[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank), default=None)
            if found is None:
                return symbols
            u, v = symbols[found[1]], symbols[found[1] + 1]
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == (u, v):
                    out.append(u + v)
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out

    def base(text):
        return list(text[:-2]) + [text[-2:]] if text.endswith(bpe.END) else list(text)

    rng = random.Random(3)
    ids = sorted(automaton.ids)
    inner = [t for t in ids if not t.endswith(bpe.END)]
    seen = set()
    for _ in range(4000):
        left, right = rng.choice(inner), rng.choice(ids)
        if merged(base(left)) == [left] and merged(base(right)) == [right]:
            apart = merged(base(left) + base(right)) == [left, right]
            assert automaton.arc(left, right) == automaton.follows(left, right) == apart
            seen.add(apart)
    assert seen == {True, False}
    automaton.forget()
    for _ in range(300):
        word = "".join(rng.choice(inner) for _ in range(rng.randint(1, 4)))[:24]
        assert automaton.path(word + bpe.END) == merged(base(word + bpe.END))
        for end in range(1, len(word) + 1):
            assert automaton.path(word[:end]) == merged(base(word[:end]))
    # One transition per state and symbol, and every state is reached by one.
    reached = [after for row in automaton.rows for after in row.values()]
    assert sorted(reached) == list(range(1, len(automaton.last)))


def test_bpe_encoder_memory_is_bounded():
    import subprocess
    import sys

    # 250,000 words read once, as in the tail of a corpus: 237 MB when transitions held strings of their own.
    code = f"""
import random, re
from roomtide.llm import bpe
def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024
encoder = bpe.Tokenizer.encoder(bpe.Tokenizer("{TOKENIZERS}/word_bpe_49k.json").parts())
rng, before = random.Random(5), held()
for _ in range(250):
    encoder.encode(" ".join("".join(rng.choices("aeioulnrst", k=10)) for _ in range(1000)))
print(held() - before)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                          cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    assert float(done.stdout) < 140


def test_recent_words_move_over_and_rare_ones_go(tokenizer):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(f"{TOKENIZERS}/word_bpe_49k.json")
    encoder = bpe.Tokenizer.encoder(tokenizer.parts())
    encoder.most, encoder.states, encoder.arcs = 10, 20, 5
    rng, read = random.Random(7), collections.Counter()
    once = encoder.read
    encoder.read = lambda word: read.update([word]) or once(word)
    for _ in range(300):
        text = "often " + "".join(rng.choices("abcdé", k=6))
        assert encoder.encode(text) == " ".join(map(str, library.encode(text, add_special_tokens=False).ids))
        assert len(encoder) <= 10 and len(encoder.older) <= 10
    assert read["often"] == 1


def test_token_files_read_a_word_once_and_equal_the_library():
    import json

    from tokenizers import Tokenizer

    with open(f"{TOKENIZERS}/byte_bpe_50k.json", encoding="utf-8") as file:
        spec = file.read()
    texts = ["", "the cat and the cat", "a  b \n\n c\t", "it's 'S we'll", "x" * 5000, " " * 300 + "y", "<|endoftext|>",
             "a\x1cb\x85c\u180ed", "日本語の文です。" * 20, "e\u0301 ΑΣ İ", "a\U000323b0b \u088f1 \U00011de0", "\u0558z"]
    rng = random.Random(3)
    texts += ["".join(rng.choices("ab 1!'s\n\t\u00a0é語\U0001f600\u0301٣", k=30)) for _ in range(300)]
    for normalizer in (None, {"type": "Lowercase"}):
        changed = json.dumps(json.loads(spec) | {"normalizer": normalizer})
        ids, library = tokenfiles.Ids(changed), Tokenizer.from_str(changed)
        library.encode_special_tokens = True
        ids.most = 50
        for text in texts:
            assert ids.of(text) == np.asarray(library.encode(text, add_special_tokens=False).ids, "<u2").tobytes(), ascii(text)
            assert len(ids) <= 50 and len(ids.older) <= 50
        assert all(len(w) <= ids.longest for w in ids) and bool(ids) == (normalizer is None)
    ids, read = tokenfiles.Ids(spec), []
    once = ids.read
    ids.read = lambda word: read.append(word) or once(word)
    ids.of("the cat and the cat" * 3)
    assert len(read) == len(set(read)) < 6


def test_token_file_words_equal_the_library_on_every_code_point():
    from tokenizers import Tokenizer

    with open(f"{TOKENIZERS}/byte_bpe_50k.json", encoding="utf-8") as file:
        spec = file.read()
    ids, library = tokenfiles.Ids(spec), Tokenizer.from_str(spec)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 50_000):
        texts = [f"a{chr(c)}1 {chr(c)}! {chr(c)}" for c in points[at:at + 50_000]]
        for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
            assert ids.of(text) == np.asarray(found.ids, "<u2").tobytes(), ascii(text)


class Taken:
    """In place of a frame: keeps the function that a task would run."""

    columns = ["doc_id", "text"]

    def __init__(self):
        self.sparkSession = self.sparkContext = self.schema = self

    def select(self, *columns):
        return self

    def add(self, *field):
        return self

    def broadcast(self, value):
        self.value = value
        return self

    def mapInArrow(self, function, schema):
        self.run = function
        return self


def peak(function, batch):
    """What a task returns, and the most MB that it allocates in Python and numpy."""
    tracemalloc.start()
    try:
        out = list(function(iter([batch])))
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


@pytest.fixture(scope="module")
def one_task():
    """About 14 MB of text in one batch, and copies of its first texts at the end."""
    rng = np.random.default_rng(2)
    texts = [" ".join(map(str, row)) for row in rng.integers(100_000, 500_000, (4500, 450))]
    texts += texts[:200]
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])


def test_tokens_by_range_are_whole_in_little_memory(monkeypatch, one_task):
    monkeypatch.setattr(jaccard, "_texts", lambda documents, *others: documents)
    out, mb = peak(jaccard._ranged(Taken(), 5, 64).run, one_task)
    assert mb < 100, mb
    found = words.words_of(one_task.column("text"), words.Hasher())
    want = {}
    for d in range(one_task.num_rows):
        values = words.shingle_set(found.hashes[found.first[d]:found.first[d + 1]], 5)
        want[jaccard.class_of(values)] = values
    got = collections.defaultdict(list)
    for row in pa.Table.from_batches(out).to_pylist():
        ids, sizes, counts, high, low = (np.frombuffer(row[c], kind) for c, kind in (
            ("classes", np.int64), ("sizes", np.uint32), ("counts", np.uint32), ("high", np.uint16), ("low", np.uint32)))
        values = high.astype(np.uint64) << np.uint64(32) | low
        assert (values >> np.uint64(42) == row["range"]).all() and counts.sum() == len(values)
        for name, size, part in zip(ids.tolist(), sizes, np.split(values, np.cumsum(counts)[:-1])):
            assert size == len(want[name])
            got[name].append(part)
    # Each class once, copies included, and all its tokens.
    assert got.keys() == want.keys() and len(want) == 4500
    assert all(np.array_equal(np.sort(np.concatenate(got[c])), want[c] >> np.uint64(16)) for c in want)


def test_toxicity_is_scored_in_little_memory(one_task):
    taken = Taken()
    toxicity.score(taken, toxicity.Network())
    out, mb = peak(taken.run, one_task)
    assert mb < 120, mb
    assert sum(b.num_rows for b in out) == one_task.num_rows
