"""Operators on texts against brute force: mixing, pseudonyms, Jaccard join, language, packing, quality, sharding."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridledger.llm import jaccard, langid, mixing, packing, pii, quality, sharding, textkeys
from gridledger.llm.queries import word_tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i}" for i in range(20_000))
#: NULLs, empty and very long texts, ties, repeated rows.
ODD = [
    (1, "a b c d e f", "s1"), (1, "a b c d e f", "s1"), (2, "A B c d e f", "s2"), (3, None, None), (None, "", "s1"),
    (4, LONG, "s2"), (5, "x", None), (6, " \n\t ", "s3"), (7, LONG + " tail", "s2"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, and extra columns named like what the operators make."""
    rows = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    return rows.selectExpr("*", "7 AS size", "8 AS start", "9 AS mix_key", "'x' AS kept", "'y' AS lang_pred", "1 AS n_words")


@pytest.fixture(scope="module")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def sets_of(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 4:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3))


def brute_classes(rows):
    """Smallest id reachable by links, by comparing all pairs."""
    sets = [sets_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[root(i)].append(d)
    return sorted(
        (str(d), len(sets[i]), min((x for x in least[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows))


def test_jaccard_equals_all_pairs(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    base = "one two three four five six seven eight nine ten " * 3 + " ".join(f"v{i}" for i in range(60))
    near = [(10_000 + i, base + f" end{i}") for i in range(400)]  # a hot group of near copies, several tiles
    given = spark.createDataFrame(rows + near, "doc_id long, text string")
    found = jaccard.classes(given).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in found) == brute_classes(rows + near)


def test_jaccard_on_odd_rows(odd):
    found = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.classes(odd).collect())
    assert found == brute_classes([(d, t) for d, t, _ in ODD])
    assert jaccard.classes(odd.limit(0)).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "6", "None"]


def test_no_range_gets_a_row_of_every_document(monkeypatch):
    """Blocks deal their documents' ids over all ranges, each block's once."""
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 20)
    texts = [f"a{i} b{i} c{i} d{i} e{i}" if i % 7 else "" for i in range(4000)]
    batches = [pa.record_batch([pa.array(range(at, at + 20)), pa.array(texts[at : at + 20])], names=["key", "text"]) for at in range(0, 4000, 20)]
    held, seen = Counter(), []
    for cell in jaccard._cells(4, 3, pa.int64())(iter(batches)):
        for r, ids, prints, sizes in zip(*(cell[c].to_pylist() for c in ("range", "ids", "prints", "sizes")), strict=True):
            assert len(ids) == len(prints) == len(sizes)
            held[r] += len(ids)
            seen += ids
    assert sorted(seen) == list(range(4000)) and len(held) == 8 and max(held.values()) < 1600
    assert jaccard.range_bits(0, 1 << 30) > 10 and jaccard.range_bits(0, 0) == 3


def test_tiles_lose_no_link():
    rng = np.random.default_rng(3)
    base = np.sort(rng.integers(0, 2**63, 300, dtype=np.uint64))
    sets = []
    for _ in range(60):
        keep = base[rng.random(300) > 0.06 * rng.random()]
        sets.append(np.sort(np.append(keep, rng.integers(0, 2**63, rng.integers(0, 30), dtype=np.uint64))))
    at = np.arange(len(sets))

    def label(pairs):
        parent = list(range(len(sets)))
        for i, j in pairs:
            a, b = parent[i], parent[j]
            parent = [b if p == a else p for p in parent]
        return [parent.index(p) for p in parent]

    linked = [(i, j) for i in at for j in at[:i]
              if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))]
    assert label(jaccard.links(sets, at, at, 85)) == label(linked)


def test_mixing_comes_near_its_targets(documents):
    rows = mixing.mix_sizes(documents).join(documents.select("doc_id", "source"), "doc_id").toPandas()
    sizes = rows.groupby("source")["size"].sum()
    order = sorted(sizes.index)
    weights = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sizes.sum(), set()
    while True:  # share, fix what is above its limit, share the excess again
        open_ = [s for s in order if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not above:
            break
        full |= above
    for source, part in rows.groupby("source"):
        target = 3 * sizes[source] if source in full else share[source]
        assert part["target"].iloc[0] == pytest.approx(target)
        assert abs(part["taken"].sum() - target) <= part["size"].max() / 2 + 1
        assert (part["taken"] % part["size"].clip(lower=1) == 0).all() and (part["taken"] <= 3 * part["size"]).all()


def test_mixing_odd_rows(odd):
    planned = mixing.mix_sizes(odd).collect()
    assert len(planned) == len(ODD) and all(r.taken <= 3 * r.size for r in planned)
    assert mixing.mix(odd).columns == [c for c in odd.columns if c != "mix_key"]
    assert mixing.mix_sizes(odd.limit(0)).count() == 0 and mixing.mix(odd.limit(0)).count() == 0
    copies = Counter({r.doc_id: r.copies for r in planned})
    taken = Counter(r.doc_id for r in mixing.mix(odd).collect())
    assert taken[4] == copies[4] and taken[1] == 2 * copies[1]


def test_large_group_is_joined_without_all_its_tile_pairs(spark, monkeypatch):
    """A group of copies costs in proportion to its size; what its tiles leave apart is compared in full."""
    monkeypatch.setattr(jaccard, "TILE", 16)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]

    def vary(words, k):
        words = list(words)
        for _ in range(k):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        return " ".join(words)

    copies = [vary(base, 1) for _ in range(320)]
    apart = [vary(base, rng.choice([4, 6, 8, 12])) for _ in range(60)] + [" ".join(base[: rng.randrange(60, 200)]) for _ in range(30)]
    others = [vary(base[:100] + [f"z{i}" for i in range(100)], rng.choice([0, 2, 4, 9])) for _ in range(60)]
    dealt, found = [], jaccard._found

    def counted(placed, *rest):
        dealt.append(placed.selectExpr("coalesce(sum(size(every)), 0)").first()[0])
        return found(placed, *rest)

    monkeypatch.setattr(jaccard, "_found", counted)
    for texts, most in ((copies, 4 * len(copies)), (copies + apart + others, None)):
        del dealt[:]
        sets = [set(s.tolist()) for s in textkeys.shingle_sets(pa.array(texts), 4)]
        least = list(range(len(texts)))

        def root(x):
            while least[x] != x:
                x = least[x]
            return x

        for i, a in enumerate(sets):
            for j in range(i):
                if 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                    x, y = sorted((root(i), root(j)))
                    least[y] = x
        rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        assert {r.doc_id: r.component_id for r in jaccard.classes(rows).collect()} == {i: root(i) for i in range(len(texts))}
        assert most is None or sum(dealt) <= most  # all tile pairs: 20 or more rows for each of 320 documents
        assert most or len(dealt) == 2


def test_pipeline_keeps_one_of_a_large_group(spark, monkeypatch):
    """The pipeline's near copies take the same way as op3: rows dealt to tile pairs grow with the group, not with its square."""
    monkeypatch.setattr(jaccard, "TILE", 16)
    rng, dealt, found = random.Random(6), [], jaccard._found

    def counted(placed, *rest):
        dealt.append(placed.selectExpr("coalesce(sum(size(every)), 0)").first()[0])
        return found(placed, *rest)

    monkeypatch.setattr(jaccard, "_found", counted)
    base = [f"w{i}" for i in range(200)]
    copies = [" ".join([*base[:k], f"x{i}", *base[k + 1 :]]) for i, k in enumerate(rng.choices(range(200), k=320))]
    rows = spark.createDataFrame([*enumerate(copies), (400, "something else that is in no other text"), (401, None)], "doc_id long, text string")
    kept = corpus_pipeline.near_copies(spark, rows, "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 400, 401] and sum(dealt) <= 4 * len(copies)


def luhn(number):
    digits = [int(c) for c in reversed(re.sub(r"\D", "", number))]
    return sum(digits[::2] + [sum(divmod(2 * d, 10)) for d in digits[1::2]]) % 10 == 0


def pseudonyms(spark, texts, key="k"):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.text for r in pii.pseudonymise(rows, key).orderBy("i").collect()]


def test_pseudonyms_keep_the_format(spark):
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "378282246310005"]
    dates = ["1984-02-29", "29.02.1984", "2/29/1984", "1900-01-01"]
    others = ["bob@x.org", "10.0.255.1", "+1 (988) 555-2485", "123-45-6789", "DE89370400440532013000"]
    found = pseudonyms(spark, cards + dates + others)
    assert all(luhn(x) for x in found[:4]) and len({re.sub(r"\D", "", x) for x in found[:3]}) == 1
    shape = lambda x: re.sub("[a-z]", "a", re.sub(r"\d", "9", x))
    assert [shape(a) for a in cards] == [shape(a) for a in found[:4]]
    iso, dotted, slashed = found[4], found[5].split("."), found[6].split("/")
    assert iso == "-".join((dotted[2], dotted[1].zfill(2), dotted[0].zfill(2)))
    assert iso == "-".join((slashed[2], slashed[0].zfill(2), slashed[1].zfill(2)))
    assert all(a != b for a, b in zip(cards + dates + others, found, strict=True))
    assert all(int(x) < 256 for x in found[9].split(".")) and re.fullmatch(r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", found[10])
    iban = found[12][4:] + found[12][:4]
    assert int("".join(str(int(c, 36)) for c in iban)) % 97 == 1
    assert pseudonyms(spark, cards, "other") != found[:4]


def test_every_phone_number_is_permuted(spark):
    """Areas and exchanges below 200 too; each kind of number stays a kind, and different ones stay different."""
    given = ["+1 (017) 555-7713", "+1 (136) 555-7479", "(212) 055-7713", "000-000-0000", "199-999-9999", "200-199-9999", "212-555-0187"]
    found = pseudonyms(spark, given)
    assert all(a != b for a, b in zip(given, found, strict=True)) and len(set(found)) == len(given)
    assert [re.sub(r"\d", "9", a) for a in given] == [re.sub(r"\d", "9", a) for a in found]

    def kind(x):
        ten = re.sub(r"\D", "", x)[-10:]
        return (ten[:3] < "200", ten[:3] >= "200" and ten[3:6] < "200")

    assert [kind(a) for a in given] == [kind(a) for a in found]
    many = [f"{a:03d}-{e:03d}-{n:04d}" for a in (0, 17, 199, 200, 999) for e in (0, 55, 199, 200, 999) for n in range(40)]
    assert len(set(pseudonyms(spark, many))) == len(many)


def test_values_are_permuted_to_their_end(spark):
    part = "Ab3kX9qLm2" * 8
    secrets = [f"token={part}.{part}.{part}", "api_key: " + "aB3dE6gH" * 60, "password='aaaa!bbbb=cccc~dddd'", "secret=S3cr@tP4ss.tail99 next"]
    ibans = ["AT61 1904 3002 3457 3201 EUR", "BE68 5390 0754 7034 EUR", "DE89 3704 0044 0532 0130 00 EUR 12", "AT611904300234573201"]
    phones = ["+1 212 555 0187", "212 555-0187", "+12125550187", "1 212 555 0187", "+1 (212) 555 0187", "212 555 0187"]
    given = secrets + ibans + phones
    found = pseudonyms(spark, given)
    shape = lambda x: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", x)))
    assert [shape(a) for a in given] == [shape(a) for a in found]
    values = lambda x: re.findall(r"[A-Za-z0-9]{4,}", re.split("[=:]", x, maxsplit=1)[1])
    for a, b in zip(secrets, found, strict=False):
        assert all(x != y or x == "next" for x, y in zip(values(a), values(b), strict=True))
    assert found[1][-60:] != given[1][-60:] and found[3].endswith(" next")
    for a, b in zip(ibans, found[4:8], strict=True):
        length = 16 if a.startswith("BE") else 22 if a.startswith("DE") else 20
        body = b.replace(" ", "")[:length]
        assert a != b and int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97 == 1
        assert a.replace(" ", "")[length:] == b.replace(" ", "")[length:]
    assert len({re.sub(r"\D", "", x)[-10:] for x in found[8:]}) == 1
    assert all(a != b for a, b in zip(given, found, strict=True))


def test_what_is_not_valid_stays(spark):
    texts = ["4111111111111112", "300.1.1.1", "1984-02-30", "000-12-3456", "no data, 12 345", "", None, LONG]
    assert pseudonyms(spark, texts) == texts


def test_feistel_is_a_permutation(spark):
    """Every small string has a pseudonym of its own, and the same in any text."""
    values = [f"{i:03d}" for i in range(1000)]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    found = [r[0] for r in rows.select(pii.permuted("k", "t", F.col("v"), pii.DIGITS)).collect()]
    assert sorted(found) == values and found != values
    days = spark.range(36_500).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("d"))
    assert days.select(pii._iso_date("k", F.col("d"))).distinct().count() == 36_500


def test_pseudonyms_on_odd_rows(odd):
    found = pii.pseudonymise(odd, "k", count="size")
    assert set(found.columns) == set(odd.columns) and found.count() == len(ODD)
    assert pii.pseudonymise(odd.limit(0), "k").count() == 0


def test_language_on_held_out_documents(documents):
    out = langid.held_out(F.col("doc_id"))
    found = langid.identify(documents.withColumn("held_out", out), langid.learn(documents.filter(~out))).toPandas()
    test = found[found.held_out]
    assert (test.lang == test.lang_pred).mean() > 0.95 and found.score.between(0, 1).all()


def test_language_on_odd_rows(spark, odd, documents):
    profiles = langid.learn(documents)
    found = {str(r.doc_id): r for r in langid.identify(odd, profiles).collect()}
    assert found["3"].lang_pred == found["None"].lang_pred == found["6"].lang_pred == "und" and found["3"].score == 0
    assert found["4"].lang_pred in profiles
    assert langid.identify(odd, profiles).count() == len(ODD) and langid.identify(odd.limit(0), profiles).count() == 0
    assert langid.learn(documents.limit(0)) == {} and langid.identify(odd, {}).filter("lang_pred <> 'und'").count() == 0


def test_grams_against_a_plain_count():
    text = "Ab, ab! Çé 1x"
    words = re.findall(r"[^\W\d_]+", text.lower())
    plain = Counter(g for w in words for n in (1, 2, 3) for s in [f" {w} "] for i in range(len(s) - n + 1) if (g := s[i : i + n]) != " ")
    values, counts = langid.grams(text)
    assert sorted(counts.tolist()) == sorted(plain.values()) and len(values) == len(plain)


def test_packing_round_trip(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_tokenizer())
    tricky = ["don't a$'s '$a", "a<|endoftext|>b, c", "J̌! x≠y ΑΣ", "日本語 z\x1cq 12.5%", None, "", "  "]
    rows = documents.select("doc_id", "text").union(
        spark.createDataFrame([(-1 - i, t) for i, t in enumerate(tricky)], "doc_id long, text string"))
    pieces = defaultdict(list)
    seen = set()
    for r in packing.pack(rows, word_tokenizer()).collect():
        assert r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0 and 1 << r.bucket == r.length
        assert r.sequence_id not in seen
        seen.add(r.sequence_id)
        pieces[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for r in rows.collect():
        expected = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        assert [x for _, ids in sorted(pieces[r.doc_id]) for x in ids] == expected


def test_packing_odd_rows(odd):
    found = packing.pack(odd, word_tokenizer()).collect()
    assert Counter(r.doc_id for r in found if r.start == 0) == Counter(d for d, _, _ in ODD)
    assert packing.pack(odd.limit(0), word_tokenizer()).count() == 0


def brute_features(text):
    words = WORD.findall(text or "")
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_features_and_verdict(spark, documents, folder):
    extra = spark.createDataFrame([(-1, "a b c d e f g h " * 5 + "\nx\nx\n \n"), (-2, None), (-3, LONG)], "doc_id long, text string")
    rows = documents.select("doc_id", "text").union(extra)
    found = {r.doc_id: r for r in quality.judge(rows).collect()}
    for r in rows.collect():
        assert tuple(found[r.doc_id][c] for c in quality.FEATURES) == brute_features(r.text)
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    right = [found[r.doc_id].kept == bool(r.quality) for r in labels if not found[r.doc_id].base_failed]
    assert sum(right) >= 0.95 * len(right)


def test_quality_odd_rows(odd):
    found = quality.judge(odd).collect()
    assert len(found) == len(ODD) and not any(r.kept for r in found if r.n_words < 20)
    assert quality.judge(odd.limit(0)).count() == 0


def test_lookup_table_takes_turns():
    shards, size = ["a", "b", "c"], 13
    owner = sharding.lookup_table(shards, size)
    assert sorted(Counter(owner).values()) == [4, 4, 5]
    more = sharding.lookup_table(["a", "b", "c", "d"], 6553)
    fewer = sharding.lookup_table(["a", "b", "c"], 6553)
    moved = sum(x != y for x, y in zip(more, fewer, strict=True) if x < 3)
    assert moved < 0.25 * 6553
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, 12)


def test_placement_on_odd_rows(odd):
    placed = sharding.place(odd, F.col("doc_id")).collect()
    assert len(placed) == len(ODD) and all(r.shard for r in placed)
    assert len({r.shard for r in placed if r.doc_id == 1}) == 1
    assert sharding.place(odd.limit(0), F.col("doc_id")).count() == 0
