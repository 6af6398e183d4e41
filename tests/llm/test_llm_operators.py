"""Every operator against a plain version, on odd rows: NULLs, empty and very long texts,
ties, repeated rows, empty tables, further columns with clashing names."""

import hashlib
import random
import re
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from collodec.llm import (
    conversations,
    decontaminate,
    fingerprint,
    jaccard_join,
    lexical,
    pieces,
    pii,
    quality,
    secrets,
    suffix_dedup,
    tokenfile,
    toxicity,
    transducer,
)
from collodec.llm.queries import tokenizer_path

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "h long, node string, score double, `row` string, ids string, spans string, `odd name.` int"
)


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "Tion", "ré", "ing", "so", "and", "cat"]) + rng.choice("abcdé") for _ in range(n))


def odd_rows():
    rng = random.Random(7)
    passage, long = words(rng, 40), words(rng, 9000)
    texts = [
        "", None, "one", "one two", " one  two ", "ONE two", "\t\n", "x" * 3000, passage, passage, passage + " end",
        words(rng, 60) + " " + passage + "\n" + words(rng, 50), long, long + " more", long[:30000], "a" * 49, "a" * 50, "a" * 51, "ab" * 60,
        'token = "0123456789abcdef0123456789abcdef01234567", secret: token: abcdefghijklmnop ' + passage,
        "AKIA" + "A1" * 9 + " AKIA12 password=abc api_key: 'abcdefghijkl' ſecret=abcdefghijklmn",
        "漢字テスト 🎉 <|endoftext|> ▁x  y", "deadbeefdeadbeef" * 3,
    ]
    for size in (30, 80, 200):  # near copies, one word after the other changed
        base = words(rng, size).split(" ")
        for k in range(6):
            texts.append(" ".join(base))
            base[(k * 17) % size] = f"new{k}"
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], rows[30], (4, "another text of the same id"), (None, passage), (None, None), (None, passage)]
    random.Random(1).shuffle(rows)
    return rows


ROWS = odd_rows()


@pytest.fixture(scope="module")
def docs(spark):
    full = [(i, t, None, "s", None, 1, "n", None, "r", None, None, 3) for i, t in ROWS]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(rows):
    return sorted(rows, key=repr)


def test_decontaminate(spark, docs, nothing):
    items = [(1, ROWS[0][1]), (2, None), (3, "one"), (10, words(random.Random(7), 40)), (10, "cat"), (None, "ONE TWO!"), (4, ""), (3, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = decontaminate.brute_force([t for _, t in ROWS], [("null" if i is None else i, t) for i, t in items])
    expected = [(i, n, h, len(x), decontaminate.sha256(x), h > 0 and 20 * h >= n) for (i, _), (n, h, x) in zip(ROWS, expected)]
    for block_bytes in (1 << 20, 50):  # one block, and several
        found = decontaminate.decontaminate(docs, bench, "doc_id", block_bytes=block_bytes)
        assert pairs(map(tuple, decontaminate.digest(found).collect())) == pairs(expected)
    assert any(e[5] for e in expected) and decontaminate.keep_clean(docs, bench).columns == docs.columns
    assert decontaminate.keep_clean(docs, bench).count() == sum(not e[5] for e in expected)
    none = decontaminate.decontaminate(docs, bench.where("false"), "doc_id")
    assert none.where("n_hit > 0").count() == 0 and none.count() == len(ROWS)
    assert decontaminate.decontaminate(nothing, bench, "doc_id").count() == 0


def test_removal_spans_are_code_points(spark):
    docs = spark.createDataFrame([(1, "é é, one two x one"), (2, "")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.decontaminate(docs, bench, "doc_id").collect()}
    assert rows[1].removal == [[5, 12]] and rows[1].n_hit == 2 and rows[2].removal == []


@pytest.mark.parametrize("seed", range(5))
def test_fm_index(seed):
    rng = np.random.default_rng(seed)
    symbols = rng.integers(0, 4, int(rng.integers(2, 400)))
    index = decontaminate.FMIndex(symbols, 4)
    phrases = rng.integers(0, 4, (30, 3))
    which, low, high = index.search(phrases)
    found = {int(w): sorted(index.locate(np.arange(a, b))) for w, a, b in zip(which, low, high)}
    for k, phrase in enumerate(phrases):
        own = [i for i in range(len(symbols) - 2) if (symbols[i : i + 3] == phrase).all()]
        assert found.get(k, []) == own


def test_secret_scan(spark, docs, nothing, tmp_path):
    expected = [(i, *brute.secrets(t)) for i, t in ROWS]
    got = secrets.scan_documents(docs)
    assert pairs(tuple(r)[:5] for r in got.collect()) == pairs(expected)
    assert {r.doc_id for r in got.where("n_assign > 0").collect()} and secrets.scan_documents(nothing).count() == 0
    # A second scan adds nothing; new blobs and new rules alone are scanned.
    ledger = str(tmp_path / "ledger")
    secrets.scan(docs, ledger, "doc_id").count()
    blobs = spark.read.parquet(ledger).count()
    assert blobs == len({t or "" for _, t in ROWS})
    again = secrets.scan(docs, ledger, "doc_id")
    assert spark.read.parquet(ledger).count() == blobs and again.count() == len(ROWS)
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(500, "token=abcdefghijklmnopq")], "doc_id long, text string"))
    found = {r.doc_id: r.findings for r in secrets.scan(more, ledger, "doc_id").collect()}
    assert spark.read.parquet(ledger).count() == blobs + 1 and [f.kind for f in found[500]] == ["assign"]
    rules = (*secrets.RULES, ("cat", 1, "cat[a-z]", 0, 1, ()))
    secrets.scan(more, ledger, "doc_id", rules=rules).count()
    newest = spark.read.parquet(ledger).where(F.array_contains("rules", "cat@1"))
    assert newest.count() == blobs + 1 and newest.where(F.size("rules") > 1).count() == 0


def test_secret_scan_of_hot_blobs(spark, tmp_path):
    """A blob that most paths hold, split; and a ledger that two scans have both added to."""
    rows = [(i, "token = abcdefghijklmnop") for i in range(400)] + [(400 + i, f"secret: {i:016x}") for i in range(100)]
    docs = spark.createDataFrame([*rows, (None, None), (None, "token = abcdefghijklmnop")], "doc_id long, text string")
    ledger = str(tmp_path / "ledger")
    scanned = secrets.scan(docs, ledger, "doc_id")
    expected = pairs((i, tuple(secrets.find(t or ""))) for i, t in [*rows, (None, None), (None, rows[0][1])])
    assert pairs((r.doc_id, tuple(map(tuple, r.findings))) for r in scanned.collect()) == expected
    spark.read.parquet(ledger).write.mode("append").parquet(str(tmp_path / "twice"))
    spark.read.parquet(ledger).write.mode("append").parquet(str(tmp_path / "twice"))
    again = secrets.scan(docs, str(tmp_path / "twice"), "doc_id")
    assert pairs((r.doc_id, tuple(map(tuple, r.findings))) for r in again.collect()) == expected


def test_secret_scan_of_a_raised_version(spark, tmp_path):
    """Of a rule's versions only the wanted one's findings come back."""
    docs = spark.createDataFrame([(1, "cata catb dogs")], "doc_id long, text string")
    ledger = str(tmp_path / "raised")

    def scanned(version, pattern):
        rules = (("cat", version, pattern, 0, 1, ()),)
        (row,) = secrets.scan(docs, ledger, "doc_id", rules=rules).collect()
        return [(f.kind, f.start, f.end) for f in row.findings]

    assert scanned(1, "cat[a-z]") == [("cat", 0, 4), ("cat", 5, 9)]
    assert scanned(2, "catb|dogs") == [("cat", 5, 9), ("cat", 10, 14)]
    assert scanned(1, "cat[a-z]") == [("cat", 0, 4), ("cat", 5, 9)]
    assert spark.read.parquet(ledger).count() == 2
    # A ledger whose findings have no rule yet.
    without = F.transform("findings", lambda f: F.struct(f.kind.alias("kind"), f.start.alias("start"), f.end.alias("end")))
    old, ledger = ledger, str(tmp_path / "old")
    spark.read.parquet(old).withColumn("findings", without).write.parquet(ledger)
    assert scanned(2, "catb|dogs") == [("cat", 5, 9), ("cat", 10, 14)]


@pytest.mark.parametrize("user", ["", "u", "u" * 65, "u" * 5000])
@pytest.mark.parametrize("password", ["abc", "p" * 129, "p" * 5000])
def test_passwords_in_urls(user, password):
    url = f"redis://{user}:{password}@"
    assert ("url", 4, 4 + len(url)) in secrets.find(f"see {url}host/0 and http://host:80/x")


def test_pseudonyms(spark, docs, nothing):
    texts = [
        "a.b-1@ex.com and Ä.é7@b.co.uk end", "card 4111 1111 1111 1111, not 4111 1111 1111 1112", "4111111111111111",
        "1.2.3.4 999.1.1.1 1.2.3.4.5", "+1 (988) 555-2485; (212) 555-1234", "1984-02-29 29.02.1985 12/31/1999 31/12/1999",
        "123-45-6789 000-12-3456 666-12-1234", "DE89370400440532013000 and GB82 WEST 1234 5698 7654 32, DE88370400440532013000", "", None,
        "x" * 100000 + " a.b-1@ex.com",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.pseudonymize(df, "key").collect()}
    luhn = lambda s: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0
    form = lambda s: re.sub(r"[a-z]", "a", re.sub(r"\d", "9", s))
    assert got[8] == "" and got[9] is None
    assert re.fullmatch(r"[a-z]\.[a-z]-\d@ex\.com and .\..\d@b\.co\.uk end", got[0]) and got[0][:7] != texts[0][:7]
    spaced, bare = re.search(r"\d{4} \d{4} \d{4} \d{4}", got[1])[0], got[2]
    assert spaced.replace(" ", "") == bare != "4111111111111111" and luhn(bare) and bare[0] == "4"
    assert got[1].endswith("not 4111 1111 1111 1112")
    assert got[3].endswith(" 999.1.1.1 1.2.3.4.5") and all(int(o) < 256 for o in got[3].split(" ")[0].split("."))
    assert form(got[4]) == form(texts[4]) and got[4] != texts[4] and got[4].startswith("+1 (")
    assert "29.02.1985" in got[5] and "1984-02-29" not in got[5] and re.match(r"\d{4}-\d\d-\d\d ", got[5])
    assert "000-12-3456 666-12-1234" in got[6] and form(got[6]) == form(texts[6])
    numbers = re.findall(r"[A-Z]{2}\d{2}[A-Z0-9 ]{15,}[0-9]", got[7])
    for n in numbers[:2]:
        bare = n.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
    assert got[7].endswith("DE88370400440532013000")
    assert got[10][-12:] == got[0][:12]  # linked across texts of any length
    other = {r.doc_id: r.text for r in pii.pseudonymize(df, "other key").collect()}
    assert other[2] != got[2]
    # Texts without such values, and all other columns, stay as they are.
    assert pairs(map(tuple, pii.pseudonymize(docs).collect())) == pairs(map(tuple, docs.collect()))
    assert pii.pseudonymize(nothing).count() == 0


def test_pseudonyms_are_permutations(spark):
    """All values of small formats, each reached once."""
    ips = spark.range(3000).selectExpr("concat_ws('.', 10, 0, id div 256, id % 256) v")
    dates = spark.range(3000).selectExpr("cast(date_add(DATE'1950-01-01', int(id)) AS string) v")
    serials = spark.range(1, 3000).selectExpr("concat('123-45-', lpad(id, 4, '0')) v")
    for df in (ips, dates, serials):
        changed = df.select(F.col("v"), pii.replaced(F.col("v"), "k").alias("p"))
        assert changed.select("p").distinct().count() == df.count()
        assert changed.where("p = v").count() <= 3 and changed.where("length(p) < 7").count() == 0


def test_sentencepiece(spark, docs, nothing):
    from sentencepiece import SentencePieceProcessor

    path = tokenizer_path("piece_bpe_32k.model")
    vocabulary, library = pieces.Vocabulary(path), SentencePieceProcessor(model_file=path)
    got = pieces.encode_documents(docs, vocabulary, check=True)
    assert got.where("NOT round_trip").count() == 0 and pieces.encode_documents(nothing, vocabulary).count() == 0
    expected = [(i, library.encode(t or "")) for i, t in ROWS]
    assert pairs((r.doc_id, list(r.ids)) for r in got.collect()) == pairs(expected)
    decoded = pieces.decode_documents(got, vocabulary).collect()
    assert pairs((r.doc_id, r.text) for r in decoded) == pairs((i, library.decode(x)) for i, x in expected)


def test_sentencepiece_of_random_text():
    from sentencepiece import SentencePieceProcessor

    path = tokenizer_path("piece_bpe_32k.model")
    vocabulary, library = pieces.Vocabulary(path), SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    texts = ["".join(rng.choice("aabcdeE  thnr.,▁é漢\n\t0") for _ in range(rng.randint(1, 70))) for _ in range(800)]
    import pyarrow as pa

    ids, counts = pieces.Encoder(vocabulary).encode(pa.array(texts))
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == library.encode(texts)


def test_token_files(spark, docs, nothing):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = sorted(map(tuple, tokenfile.round_trip(docs, path).collect()), key=lambda r: r[1])
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    at, expected = 0, []
    for doc_id, text in order:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        expected.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == expected and tokenfile.round_trip(nothing, path).count() == 0


@pytest.mark.parametrize("top", [1, 2, 3, 100, 50257, 2**31, 2**60, 2**64 - 1])
@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000, 300_001])
def test_simple8b(top, n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, top, n, dtype=np.uint64)
    values[rng.random(n) < 0.3] = 0
    packed, offsets = tokenfile.pack(values)
    assert (tokenfile.unpack(packed, n) == values).all() and len(offsets) == -(-n // tokenfile.BLOCK)
    if n > 1000:
        assert (tokenfile.unpack_blocks(packed, offsets, n, 3, 7) == values[3 * 128 : 7 * 128]).all()
    ids, keys, starts = tokenfile.from_file(tokenfile.to_file(values, [None, 5], np.array([0, n])))
    assert (ids == values).all() and keys == [None, 5] and starts.tolist() == [0, n]


def test_jaccard_join(docs, nothing):
    known = [r for r in ROWS]
    expected = brute.components([i for i, _ in known], [t for _, t in known])
    expected = [(i, n, i if n == 0 else c) for (i, _), (n, c) in zip(known, expected)]
    assert pairs(map(tuple, jaccard_join.join_documents(docs).collect())) == pairs(expected)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and jaccard_join.keep_one(nothing).count() == 0
    groups = {c for _, n, c in expected if n}
    ids = [r.doc_id for r in kept.collect() if brute.shingles(r.text)]
    assert sorted(ids) == sorted(groups)
    assert kept.count() - len(ids) == sum(n == 0 for _, n, _ in expected)
    assert jaccard_join.join_documents(nothing).count() == 0


def test_frequent_tokens_make_pairs(spark, monkeypatch):
    """Every token frequent, some, or none: the same links."""
    rng = random.Random(5)
    bases = [words(rng, 60).split(" ") for _ in range(6)]
    passage = words(rng, 12)
    rows = []
    for i in range(120):
        own = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = f"w{rng.randrange(40)}"
        rows.append((i, " ".join(own) + (" " + passage if i % 2 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = brute.components(*zip(*rows))
    for local, frequent in ((3, 32), (1, 0), (2, 4)):
        monkeypatch.setattr(jaccard_join, "LOCAL", local)
        monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_documents(docs).collect()}
        assert [got[i] for i, _ in rows] == expected
    assert len({c for _, c in expected}) > 6


def test_one_sided_edits_of_rare_tokens(spark):
    """Isolated pairs near the threshold: what only one of two has may push shared tokens out of its prefix."""
    rng = random.Random(11)
    rows, near = [], 0
    for k in range(150):
        n = rng.randint(30, 160)
        own = [f"{k}u{i}" for i in range(n)]
        more = [f"{k}v{i}" for i in range(rng.randint((n - 4) * 15 // 100, (n - 4) // 4))]
        at = (n, rng.randrange(n), 0)[k % 3]  # a footer, an inserted paragraph, a cut head
        texts = [" ".join(own), " ".join(own[:at] + more + own[at:])]
        a, b = map(brute.shingles, texts)
        near += 80 <= 100 * len(a & b) / len(a | b) <= 87
        rows += [(2 * k, texts[0]), (2 * k + 1, texts[1])]
    assert near > 90
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_documents(docs).collect()}
    assert [got[i] for i, _ in rows] == brute.components(*zip(*rows))


@pytest.mark.parametrize("seed", range(3))
def test_similar_sets_share_a_key(seed):
    """The prefix argument itself, over random sets and random classes of tokens."""
    rng = np.random.default_rng(seed)
    for _ in range(400):
        n = int(rng.integers(2, 120))
        base = rng.integers(0, 1 << 62, n + 40).astype(np.uint64)
        x, y = np.unique(base[:n]), np.unique(np.concatenate((base[: n - int(rng.integers(0, n // 8 + 1))], base[n : n + int(rng.integers(0, n // 8 + 1))])))
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        share = rng.random()
        keys = []
        for s in (x, y):
            frequent = (s % np.uint64(1000)) < share * 1000
            keys.append(set(np.concatenate(jaccard_join.keys_of(s, frequent)).tolist()))
        assert keys[0] & keys[1] or (x == y).all()


def test_fingerprints(spark, docs, nothing):
    own = spark.createDataFrame([(i, t) for i, t in dict(ROWS).items() if i is not None], "doc_id long, text string").repartition(3)
    rows = sorted([(r.doc_id, r.text or "") for r in own.collect()], reverse=True)
    got = {r.doc_id: r for r in fingerprint.fingerprint_documents(own).collect()}
    assert len(got) == len(rows)
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        n = len(text)
        edited = text[: n - n // 2] + following[: n // 2]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = (brute.shingles(t.lower()) for t in (text, edited, following))
        exact = len(a) < fingerprint.K and len(b) < fingerprint.K
        true = len(a & b) / len(a | b) if a | b else 1.0
        assert r.near_edited == pytest.approx(true, abs=1e-9 if exact else 0.15)
        assert 0 <= r.near_next <= 1 and (len(c) >= fingerprint.K or r.n_shingles == pytest.approx(len(a), rel=0.4))
    prints = {}
    for doc_id, text in rows:
        assert prints.setdefault(text, got[doc_id].fingerprint) == got[doc_id].fingerprint
    assert fingerprint.fingerprint_documents(docs).count() == len(ROWS)
    assert fingerprint.fingerprint_documents(nothing).count() == 0
    assert fingerprint.fingerprint_documents(own.limit(1)).count() == 1


def test_fingerprints_merge(spark):
    parts = spark.sql(
        "SELECT id % 3 AS g, array_join(transform(sequence(0, 99), x -> concat('w', id, '_', x)), ' ') AS text FROM range(12)"
    )
    merged = fingerprint.merge_groups(parts.withColumn("s", fingerprint.sketch(F.col("text"))), "g", "s")
    joined = merged.withColumn("n", fingerprint.distinct_count(F.col("s"))).collect()
    assert len(joined) == 3
    for r in joined:
        assert len(r.s) == fingerprint.K and r.s == sorted(set(r.s)) and r.n == pytest.approx(4 * 96, rel=0.3)
    a, b = F.col("a"), F.col("b")
    part = spark.sql("SELECT array(1L, 2L, 3L) a, array(1L, 2L, 3L, 4L) b, cast(array() as array<bigint>) e")
    row = part.select(fingerprint.resemblance(a, b), fingerprint.containment(a, b), fingerprint.resemblance(a, F.col("e"))).first()
    assert tuple(row) == (0.75, 1.0, 0.0)


def test_suffix_dedup(docs, nothing):
    expected = brute.kept_bytes(ROWS)
    got = suffix_dedup.remove_repeats(docs).collect()
    assert pairs(map(tuple, got)) == pairs((i, *expected[i, t]) for i, t in ROWS)
    assert any(e[1] for e in expected.values()) and suffix_dedup.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_suffix_dedup_of_random_texts(spark, seed):
    """Cuts, overlaps and chance repeats of few letters."""
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab é"[: 2 + seed]) for _ in range(rng.randint(20, 160))) for _ in range(8)]
    rows = [(rng.randrange(40), "".join(rng.choice(pool)[rng.randrange(9) :] for _ in range(rng.randint(0, 5)))) for _ in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = brute.kept_bytes(rows)
    assert pairs(map(tuple, suffix_dedup.remove_repeats(docs).collect())) == pairs((i, *expected[i, t]) for i, t in rows)


def test_anchors_are_dealt_evenly_to_shards():
    """Anchors are the grams of the least hashes; their shards do not follow from that."""
    data = np.random.default_rng(3).integers(97, 123, 400_000).astype(np.uint8)
    grams = suffix_dedup.anchors(data, np.array([0, len(data)]))[-1]
    counts = np.bincount((suffix_dedup._name(grams, 9) >> np.uint64(32)).astype(np.int64), minlength=512)
    assert counts.max() < 2 * counts.mean()


@pytest.mark.parametrize("seed", range(20))
def test_loser_tree(seed):
    rng = random.Random(seed)
    runs = [sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))).encode() for _ in range(rng.randint(0, 12))}) for _ in range(rng.randint(1, 9))]
    shares = [[0] + [suffix_dedup._shared(a, b, 0) for a, b in zip(r, r[1:])] for r in runs]
    out, before = [], b""
    for run, at, share in suffix_dedup.merged(list(zip(runs, shares))):
        out.append(runs[run][at])
        assert not before or share == suffix_dedup._shared(before, out[-1], 0)
        before = out[-1]
    assert out == sorted(s for r in runs for s in r)


def labelled(spark, seed, n=400):
    rng = random.Random(seed)
    bad = ["idiot", "moron", "i-d-i-o-t", "m o r o n", "idxiot", "Scum!!", "sc-um"]
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        text = words(rng, rng.randint(20, 80)).split(" ")
        for _ in range(rng.randint(2, 4) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(bad[: 2 if rng.random() < 0.5 else 7]))
        good = rng.random() < 0.7
        rows.append((i, " ".join(text) if good else " ".join(w + rng.choice(["$$$", "###"]) for w in text)))
        labels.append((i, int(good), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("kind", ["toxic", "quality"])
def test_classifiers(spark, docs, nothing, kind):
    own, labels = labelled(spark, 11)
    score = toxicity.score_documents if kind == "toxic" else quality.score_documents
    modulus, remainder = (3, 1) if kind == "toxic" else (5, 0)
    odd = spark.createDataFrame([(None, 1, 1), (0, None, None), (1, 1, 0), (1, 1, 0)], labels.schema)
    rows = score(own, labels.unionByName(odd)).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % modulus == remainder}
    right = sum(r.predicted == r[kind] for r in held)
    assert right >= 0.93 * len(held) and all(0 <= r.score <= 1 for r in rows)
    assert score(docs, labels).count() == len(ROWS) and score(nothing, labels).count() == 0
    # Labels of held-out rows teach nothing; without labels of both kinds the score is constant.
    turned = labels.withColumn(kind, F.when(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, 1 - F.col(kind)).otherwise(F.col(kind)))
    assert {(r.doc_id, r.predicted) for r in score(own, turned).collect()} == {(r.doc_id, r.predicted) for r in rows}
    assert {r.score > 0.5 for r in score(own, labels.where(f"{kind} = 1")).collect()} == {True}
    assert {r.score < 0.5 for r in score(own, labels.where("false")).collect()} == {True}


def test_gapped_insults(spark):
    own, labels = labelled(spark, 12)
    model = toxicity.fit(own, labels.select("doc_id", F.col("toxic").alias("label")))
    texts = ["the cata of soa idi.ot inga", "the cata of soa i d i o t inga idiiot", "the cata of soa andb inga thea sob catb"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert got[2] < 0.2 < got[0] and got[1] > got[2]


@pytest.mark.parametrize(
    "text",
    [
        "x@" + "ab." * 330_000 + "c", "DE89 " + "3704 " * 200_000, "4111 " * 200_000, "+1 " + "415 " * 250_000,
        "1.2.3." * 170_000, "1984-02-29" * 100_000, "123-45-" * 140_000, "1" * 1_000_000, "a@" * 500_000,
    ],
    ids=["email", "iban", "card", "phone", "ip", "date", "ssn", "digits", "ats"],
)
def test_pseudonyms_of_adversarial_texts(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = pii.pseudonymize(df, "key").select(F.length("text").alias("n")).collect()
    assert row.n == len(text)


def test_pseudonyms_of_other_scripts(spark):
    names = ["иван", "αβγδ", "李小龙", "שלום", "𝒜𝒞𝒟", "ñandú"]
    df = spark.createDataFrame([(n, f"{n}@пример.рф") for n in names], "name string, text string")
    for name, text in map(tuple, pii.pseudonymize(df, "key").collect()):
        local, domain = text.split("@")
        assert local != name and len(local) == len(name) and domain == "пример.рф"
        assert all(abs(ord(a) - ord(b)) < 512 for a, b in zip(local, name)) and local.isalpha()
    # All names of a group of letters, each reached once.
    letters = [chr(x) for x in range(0x0430, 0x0440)]
    pairs_ = [a + b for a in letters for b in letters]
    df = spark.createDataFrame([(f"{p}@x.ru",) for p in pairs_], "v string")
    changed = df.select(pii.replaced(F.col("v"), "key").alias("p")).distinct()
    assert changed.count() == len(pairs_)


def test_unigram_pieces_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    model.trainer_spec.model_type = 1
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="merge-ordered"):
        pieces.Vocabulary(str(path))


ITEMS = [(1, ROWS[0][1]), (2, None), (3, "one ONE two"), (3, "one ONE two"), (10, words(random.Random(7), 40)), (None, "cat é Tiond"), (4, "")]


@pytest.mark.parametrize("shard, block, items", [(1 << 24, 128, 1 << 20), (3000, 2, 40)])
def test_lexical_search(spark, docs, nothing, monkeypatch, shard, block, items):
    """One shard and many, short blocks, items in one pass and in several."""
    for name, value in (("SHARD_BYTES", shard), ("BLOCK", block), ("ITEM_BYTES", items)):
        monkeypatch.setattr(lexical, name, value)
    asked = spark.createDataFrame(ITEMS, "item_id long, text string")
    for k in (50, 3):
        index = lexical.build_index(docs)
        got = pairs(map(tuple, lexical.search(index, asked, k=k).collect()))
        assert got == pairs(brute.ranked(ROWS, ITEMS, k)) and got
    assert lexical.search_documents(nothing, asked).count() == 0
    assert lexical.search_documents(docs, asked.where("false")).count() == 0


def test_blocks_are_left_compressed():
    """Documents of one common word cannot get in beside those of a rare one."""
    rng = np.random.default_rng(1)
    n = rng.integers(20, 60, 20_000)
    hashes, places = [], []
    for term, share in ((1, 1.0), (2, 0.5), (3, 0.005)):
        own = np.flatnonzero(rng.random(len(n)) < share)
        hashes.append(np.full(len(own), term, np.uint64))
        places.append(own)
    shard = lexical.Shard.pack(np.concatenate(hashes), np.concatenate(places), n)
    weights = np.array([lexical.weight(int(d), len(n)) for d in shard.df])
    searcher = lexical.Searcher(np.arange(1, 4, dtype=np.uint64), weights, [np.arange(3)], len(n), int(n.sum()), 10)
    searcher.search(shard, lexical.pa.array(np.arange(len(n))))
    assert searcher.blocks_read < searcher.blocks_met / 2
    m = lexical.length_parts(n, len(n), int(n.sum()))
    total = np.zeros(len(n), np.int64)
    for own, w in zip(places, weights, strict=True):
        total[own] += w * lexical.frequency_parts(np.ones(len(own)), m[own])
    best = sorted(range(len(n)), key=lambda i: (-total[i], i))[:10]
    assert searcher.heaps[0].ids == best and searcher.heaps[0].scores.tolist() == total[best].tolist()


@pytest.fixture(scope="module")
def bpe():
    return transducer.Vocabulary(tokenizer_path("word_bpe_49k.json"))


def test_transducer(spark, docs, nothing, bpe):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    expected = [library.encode(t or "", add_special_tokens=False).ids for _, t in ROWS]
    encoded = transducer.encode_documents(docs, bpe, decoded=True)
    got = [(r.doc_id, r.n_tokens, list(r.ids), r.decoded) for r in encoded.collect()]
    assert pairs(got) == pairs((i, len(e), e, library.decode(e, skip_special_tokens=False)) for (i, _), e in zip(ROWS, expected))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    digests = [(i, len(e), sha(" ".join(map(str, e))), sha(library.decode(e, skip_special_tokens=False))) for (i, _), e in zip(ROWS, expected)]
    assert pairs(map(tuple, transducer.digest(encoded).collect())) == pairs(digests)
    assert transducer.encode_documents(nothing, bpe, decoded=True).count() == 0
    texts = {r.doc_id: r.text for r in transducer.decode_documents(encoded, bpe).collect()}
    assert texts[7] == "one " and texts[1] == ""


def random_text(rng):
    size = rng.choice([0, 1, 3, 20, 90, 700, 1500])
    kinds = [
        lambda: chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000), rng.randrange(0x250)])),
        lambda: rng.choice("ab' \n19!Σést"),
        lambda: rng.choice("etaoinshr"),
        lambda: rng.choice(["<|endoftext|>", "<|startoftext|>", "<|", "a", "'s", " ", "'ll", "\x1c", "\x85", "\u3000", "é", "e\u0301", "İ"]),
        lambda: rng.choice(["th", "e", "in", "ing", "er", "tion"]),
        lambda: "x",
    ]
    kind = rng.choice(kinds)
    return "".join(kind() for _ in range(size))


@pytest.mark.parametrize("seed", range(4))
def test_transducer_of_random_text(bpe, seed):
    """Also words of several windows, and an encoder that has forgotten."""
    from tokenizers import Tokenizer

    library, rng = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), random.Random(seed)
    encoder = transducer.Encoder(bpe)
    for _ in range(40):
        rows = [random_text(rng) for _ in range(8)]
        ids, counts = encoder.encode(rows)
        ends = np.cumsum(counts)
        for text, a, b in zip(rows, ends - counts, ends):
            own = library.encode(text, add_special_tokens=False).ids
            assert ids[a:b].tolist() == own
            decoder = transducer.TokenDecoder(bpe)
            assert decoder.feed(own[:3]) + decoder.feed(own[3:]) == library.decode(own, skip_special_tokens=False)
            plain = transducer.TextDecoder(bpe)
            parts = "".join(plain.feed([i]) for i in own) + plain.finish()
            whole = transducer.TextDecoder(bpe)
            assert parts == whole.feed(own) + whole.finish()


def test_simple_runs_split_as_the_library_does(bpe):
    splitter = transducer.Splitter(bpe)
    for point in range(0x250):
        for run in (chr(point), "a" + chr(point), chr(point) + "b."):
            simple = transducer._SIMPLE.fullmatch(run)
            if simple:
                letters, mark = simple.groups()
                assert list(splitter.words(run)) == [letters.lower().encode(), *([mark.encode()] if mark else [])]


def test_lookahead_is_sufficient(bpe):
    """What follows an emitted token changes nothing: windows of the least size give merging's tokens."""
    rng = random.Random(11)
    machine = transducer.Transducer(bpe)
    assert machine.window == 2 * bpe.lookahead and 32 <= bpe.lookahead < 1000
    for _ in range(60):
        word = "".join(rng.choice(["th", "e", "in", "ing", "er", "s", "an", "ti", "on"]) for _ in range(rng.randrange(100, 900))).encode()
        symbols = [bpe.inner[b] for b in word]
        symbols[-1] = bpe.final[word[-1]]
        assert list(machine.word(word)) == transducer.merge(symbols, bpe.rules)


def odd_conversations(rng):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "sys"]
    said = ["Hi.", "ok", "", "  ", None, "What?", "a b c!", "x.  ", "end\u00a0"]
    rows = []
    for c in range(150):
        for t in range(rng.choice([1, 1, 2, 3, 5, 8, 20])):
            rows.append((None if c == 7 else c, rng.choice([None, t, t, t, t + 1, t * 3]), rng.choice(roles), rng.choice(said)))
    for t in range(1500):  # several segments, also within one turn
        rows.append((1000, t if t % 50 else None, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice([f"Hi. {t}", "ok", "long. " * 500])))
    return [*rows, *[rows[3]] * 5, *[(2000, 1, "user", "again")] * 1300]


def test_conversation_repair(spark):
    rows = odd_conversations(random.Random(5))
    schema = "conv_id long, turn long, role string, text string, conv string, seg int, said string"
    table = spark.createDataFrame([(*r, None, 1, "x") for r in rows], schema).repartition(5)
    expected = {c: brute.repaired(own) for c, own in brute.damaged(rows).items()}
    got = {r[0]: tuple(r)[1:] for r in conversations.repair_conversations(table).collect()}
    assert got == expected and any(not e[6] for e in expected.values())
    assert conversations.repair_conversations(table.where("false")).count() == 0


def test_pieces_new_words_in_slices(monkeypatch):
    """New words are encoded a bounded number of characters at a time; ids do not depend on it."""
    import pyarrow as pa

    vocabulary = pieces.Vocabulary(tokenizer_path("piece_bpe_32k.model"))
    rng = random.Random(4)
    texts = pa.array([" ".join("".join(rng.choices("abcdeé ß☃", k=rng.randint(0, 30))) for _ in range(20)) for _ in range(50)])
    whole = pieces.Encoder(vocabulary).encode(texts)
    seen, encode_words = [], pieces.encode_words

    def watched(words, vocabulary):
        seen.append(words)
        return encode_words(words, vocabulary)

    monkeypatch.setattr(pieces, "WORD_CHARS", 100)
    monkeypatch.setattr(pieces, "encode_words", watched)
    parts = pieces.Encoder(vocabulary).encode(texts)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))
    assert len(seen) > 10 and max(sum(map(len, w[1:])) for w in seen) < 100
