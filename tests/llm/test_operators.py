"""Each operator against brute force, the library, SQL, or held-out labels."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pitchside.llm import (
    captures, decontaminate, language, mixing, near_dups, outliers, pseudonyms, queries, sql,
    token_counts, token_store, toxicity,
)
from tests.llm import brute

SF = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    " ", "  ", "\n", "\t", "a", "The", "É", "'s", "'LL", "12", "!!", "<|endoftext|>", "ñ", "　",
    "\x0b", "\x85", "​", "漢字", "👍🏽", "e", "́", "\x00", "\r\n", "ǅ", "²", "_", "Σ", "İ",
    "\x1c", "\x1f", "᠎", " ", "ﬁ", ",", ".", "thon,",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_texts(n: int) -> list[str]:
    draw = random.Random(3)
    return ["".join(draw.choices(PIECES, k=draw.randint(0, 12))) for _ in range(n)]


def documents() -> list[tuple[int, str]]:
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by 1").fetchall()


def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0]))


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    wanted = con.sql(sql.oracle_sql()[name]).df()
    found = queries.queries()[name](spark, SF).toPandas()
    key = found.columns[0]
    wanted = wanted[found.columns].sort_values(key).reset_index(drop=True).astype(object)
    found = found.sort_values(key).reset_index(drop=True).astype(object)
    pd.testing.assert_frame_equal(
        found.where(found.notna(), None), wanted.where(wanted.notna(), None), check_dtype=False
    )


# --- 1 and 6: tokens --------------------------------------------------------------------------


def test_word_encoder_equals_library_on_whole_texts():
    encoder, whole = token_store.Encoder(WORD_BPE, 2, True), library(WORD_BPE)
    for text in odd_texts(3_000) + [t for _, t in documents()[:60]]:
        wanted = [*whole.encode(text, add_special_tokens=False).ids, 2]
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == wanted, repr(text)


def test_forgotten_words_are_encoded_again(monkeypatch):
    monkeypatch.setattr(token_store, "WORDS_KEPT", 5)
    encoder, whole = token_store.Encoder(WORD_BPE, 2, True), library(WORD_BPE)
    for text in ["a b c d e f g h", "a b Word. word WORD, x y", "Word. a b"] * 3:
        wanted = [*whole.encode(text, add_special_tokens=False).ids, 2]
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == wanted
        assert len(encoder.words) <= 5 and len(encoder.words.before) <= 5


def test_token_counts_equal_library():
    counter, whole = token_counts.Counter(BYTE_BPE), library(BYTE_BPE)
    for text in odd_texts(3_000) + [t for _, t in documents()[:60]]:
        wanted = len(whole.encode(text, add_special_tokens=False).ids)
        assert counter.count(text) == wanted, repr(text)


def test_token_report(spark):
    whole = library(BYTE_BPE)
    wanted = []
    for i, text in documents():
        n = len(whole.encode(text, add_special_tokens=False).ids)
        wanted.append((i, len(text.encode()), n, n > 512))
    assert rows(queries.op6_token_counts(spark, SF)) == wanted


def test_token_store_round_trip(spark):
    whole, start, wanted = library(WORD_BPE), 0, []
    for i, text in documents():
        ids = [*whole.encode(text, add_special_tokens=False).ids, 2]
        wanted.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert rows(queries.op1_token_store(spark, SF)) == wanted


def test_token_report_needs_one_python_worker_per_task(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    folder = f"file://{tmp_path}/narrow"
    path = public_tokenizers.path("word_bpe_49k.json")
    token_store.write_store(docs, folder, path, end_id=2, by_word=True)
    report = token_store.store_report(spark, folder, 2)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    payload = token_store.read_ids(token_store.lookup(spark, folder, docs), folder, 2)
    wanted = {row.doc_id: token_store.wide_crc(bytes(row.ids), 2) for row in payload.collect()}
    assert {row.doc_id: row.ids_crc32 for row in report.collect()} == wanted


def test_token_store_lookup(spark, tmp_path):
    docs = spark.createDataFrame([(i * 7, f"text {i}") for i in range(3_000)], "doc_id long, text string")
    folder = str(tmp_path / "store")
    token_store.write_store(docs, folder, WORD_BPE, end_id=2, by_word=True)
    asked = spark.createDataFrame([(7,), (20_993,), (8,), (-1,), (None,)], "doc_id long")
    found = token_store.read_ids(token_store.lookup(spark, folder, asked), folder, 2).collect()
    whole = library(WORD_BPE)
    ids = {r["doc_id"]: np.frombuffer(r["ids"], "<u2").tolist() for r in found}
    assert ids == {
        key: [*whole.encode(f"text {key // 7}", add_special_tokens=False).ids, 2]
        for key in (7, 20_993)
    }


@pytest.mark.parametrize("n", [0, 1, 2, 1_000])
def test_perfect_hash_is_minimal(n):
    keys = np.arange(n, dtype=np.uint64) * np.uint64(2**40 + 1)
    found = token_store.PerfectHash.of(keys)
    again = token_store.PerfectHash.unpacked(*found.packed())
    assert sorted(again(keys).tolist()) == list(range(n))


# --- 2: near-duplicates -----------------------------------------------------------------------


def near_rows(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_near_duplicates_of_documents(spark):
    assert near_rows(queries.op2_near_duplicates(spark, SF)) == brute.near_duplicates(documents())


def chained(n: int) -> list[tuple[int, str]]:
    """A group that drifts: neighbours are alike, far ones are not; and some of no group."""
    draw = random.Random(5)
    words = [f"w{draw.randint(0, 999)}" for _ in range(150)]
    out = []
    for i in range(n):
        words[draw.randrange(len(words))] = f"x{i}"
        out.append((1_000 - i, " ".join(words)))
        out.append((5_000 + i, " ".join(f"y{draw.randint(0, 99)}" for _ in range(60))))
    return out + [(i, out[0][1].upper()) for i in range(3)]


def test_near_duplicates_of_a_drifting_group(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    docs = chained(120)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert near_rows(near_dups.near_duplicates(df)) == brute.near_duplicates(docs)


def test_texts_of_one_id_are_linked_each(spark):
    """Two texts go by the id 5 (and two by 7); each finds what is like it."""
    draw = random.Random(6)
    texts = [" ".join(f"{name}{draw.randint(0, 999)}" for _ in range(200)) for name in "abcd"]
    like = [f"{x} more" for x in texts]
    docs = [(5, texts[0]), (5, texts[1]), (9, like[0]), (11, like[1]), (7, texts[2]), (7, texts[3]),
            (3, texts[3]), (12, like[2]), (4, like[3])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = sorted((r[0], r[1]) for r in near_dups.near_duplicates(df).select("doc_id", "component_id").collect())
    assert found == [(3, 3), (4, 3), (5, 5), (5, 5), (7, 3), (7, 7), (9, 5), (11, 5), (12, 7)]


# --- 3 and 4: models --------------------------------------------------------------------------


def test_language_on_held_out_documents(spark):
    found = queries.op3_language(spark, "/root/testdata/sf0.01").where("held_out")
    lang = queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    right = found.join(lang, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.98


def plain_cost(text: str, learned: str) -> float:
    """Phrases of ``text``, each the longest part of ``learned`` from where the last one ended."""
    count = 0
    while text:
        size = max((n for n in range(1, len(text) + 1) if text[:n] in learned), default=1)
        text, count = text[size:], count + 1
    return count


def test_language_choice_equals_brute_force():
    """The least cost per symbol wins, whatever the samples' lengths."""
    samples = (
        ("a", ("the cat sat on the mat and the hat",)), ("b", ("die katze sitzt auf der matte",)),
        ("c", ("ok",)), ("d", ("le chat",)),
    )
    texts = ["the mat on the hat", "der katze", "ok ok", "le chat le chat", "xyz", "sat auf"]
    model = language.Languages(samples)
    for text, (name, score) in zip(texts, model.told(texts)):
        costs = [plain_cost(text, x[0] + " ") for _, x in samples]
        assert name == samples[costs.index(min(costs))][0], text
        least = sorted(costs)[:2]
        assert score == pytest.approx(1 - least[0] / least[1])


@pytest.mark.parametrize("extra", [
    [("xx", "ok")], [("xx", "")], [("xx", "1 2 3 !")], [(f"x{i}", f"q{i} word") for i in range(50)],
])
def test_small_languages_take_over_no_documents(spark, extra):
    """Rows with a wrong label, empty or tiny, leave the other languages' documents alone."""
    folder = "/root/testdata/sf0.01"
    docs = queries.table(spark, folder, "documents").select("doc_id", "text", "lang")
    added = spark.createDataFrame([(-4 * i - 1, t, x) for i, (x, t) in enumerate(extra)], docs.schema)
    samples = language.learned_sample(docs.where("doc_id % 4 <> 2").unionByName(added))
    assert {"de", "en", "es", "fr"} <= {name for name, _ in samples}
    held = docs.where("doc_id % 4 = 2 and lang is not null and length(text) > 40")
    found = language.with_language(held, samples)
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


def test_language_sample_is_bounded(spark):
    docs = [(i, "abc " * 500, f"l{i % 7}") for i in range(70)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    told = dict(language.learned_sample(df, sample=language.Sample(rows=8, window=30, total=1_000)))
    assert len(told) == 7 and {len(x) for x in told.values()} == {4}
    assert {len(x) for texts in told.values() for x in texts} == {30}
    assert language.Sample(total=100).shared(1_000) == (1, 1)


def test_phrases_equal_a_plain_parse():
    samples = (("a", ("abcabcabd abc",)), ("b", ("xyzxyz xxy",)))
    model = language.Languages(samples)
    texts = ["abcabd zxy", "zzz abcab", "", "q", "abc" * 1_000]
    symbols, upto = model.alphabet.symbols(texts)
    found = model.phrases(symbols, upto)
    for k, (_, learned) in enumerate(samples):
        whole, _ = model.alphabet.symbols(list(learned))
        held = bytes(whole) + bytes([language.GAP])
        for i in range(len(texts)):
            text, count = bytes(symbols[upto[i] : upto[i + 1]]), 0
            for at in range(0, len(text), language.SEGMENT):
                part = text[at : at + language.SEGMENT]
                while part:
                    size = max((n for n in range(1, len(part) + 1) if part[:n] in held), default=1)
                    part, count = part[size:], count + 1
            assert found[k, i] == count, (k, texts[i][:20])


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(2)
    scores, moves = draw.normal(size=(5, 1)), draw.normal(size=(2, 2))
    weights = np.zeros((5, 2))
    for tags in np.ndindex(*(2,) * 5):
        total = sum(scores[t, 0] for t in range(5) if tags[t])
        total += sum(moves[a, b] for a, b in zip(tags, tags[1:]))
        for t, tag in enumerate(tags):
            weights[t, tag] += np.exp(total)
    wanted = weights[:, 1] / weights.sum(axis=1)
    found = toxicity.marginals(scores, moves, np.array([5]))[:, 0]
    np.testing.assert_allclose(found, wanted)


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op4_toxicity(spark, sf).where("held_out")
    told = found.join(queries.table(spark, sf, "labels"), "doc_id").toPandas()
    right = (told.predicted == told.toxic).mean()
    caught = told.predicted[told.toxic == 1].mean()
    assert right > 0.9 and caught > 0.6


def test_only_copies_are_left_out_of_learning():
    draw = random.Random(6)
    # All texts share the words of the least hashes; every tenth is a copy with a word changed.
    common = sorted((f"common{i}" for i in range(50)), key=lambda x: zlib.crc32(x.encode()))[:5]
    kinds, copies = [], 0
    for i in range(300):
        if i % 10 == 9:
            kinds.append({*sorted(kinds[-1])[1:], f"new{i}"})
            copies += 1
        else:
            kinds.append({*common, *(f"word{draw.randrange(900)}" for _ in range(40))})
    toxic = [i // 10 % 3 == 0 for i in range(300)]
    held = []
    for i, words in enumerate(kinds):
        if not any(toxic[i] == toxic[j] and len(words & kinds[j]) >= 0.8 * len(words | kinds[j])
                   for j in held):
            held.append(i)
    assert toxicity._unlike([*map(list, kinds)], toxic) == held and len(held) == 300 - copies
    # A toxic word that occurs in six unlike texts marks, though all share the least hash.
    kinds = [{*common, f"a{i}", f"b{i}", *(["vile"] if i < 6 else [])} for i in range(60)]
    taken = toxicity._marking([*map(list, kinds)], [i < 6 for i in range(60)], toxicity.Learning())
    assert "vile" in taken


def test_toxicity_learns_from_whole_texts(spark):
    draw = random.Random(4)
    docs, labels = [], []
    for i in range(120):
        words = [f"word{draw.randrange(3_000)}" for _ in range(1_200)]
        if i % 3 == 0:
            # Beyond the first 4,000 code points, each with one of eight words.
            words[1_000:1_000] = [f"vile{(i // 3 + k) % 8}" for k in range(6)]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    chain = toxicity.learned(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    told = toxicity.with_toxicity(docs, chain).toPandas()
    found = told.score >= toxicity.Learning().threshold
    assert (found == (told.doc_id % 3 == 0)).all()
    # Windows lie around tokens from the first to the last that is marked.
    words = [f"vile{i}" if i % 100 == 0 else f"x{i}" for i in range(1_000)]
    marking = {word for word in words if word.startswith("vile")}
    some = toxicity.windows_of(words, marking, 1, toxicity.Learning())
    assert [w for part, tags in some[:4] for w, tag in zip(part, tags) if tag] == [
        "vile0", "vile300", "vile600", "vile900",
    ]


# --- 5: pseudonyms ----------------------------------------------------------------------------


def pseudonymous(spark, texts: list[str], key: str = "k") -> list:
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return pseudonyms.with_pseudonyms(df, key).orderBy("doc_id").collect()


def luhn(digits: str) -> bool:
    return sum(int(x) if i % 2 == 0 else sum(divmod(2 * int(x), 10))
               for i, x in enumerate(reversed(digits))) % 10 == 0


def test_pseudonyms_keep_formats(spark):
    texts = [
        "pay 4539 1488 0343 6467 or 4539148803436467.", "not 4539148803436468", "at 10.0.255.7!",
        "on 2020-02-29 and 29.2.2020, 29/02/2020 not 2021-02-29", "call +1 (017) 555-7713 now",
        "mail Ann.Lee-42@mail.example.com, thanks", "id 123-45-6789 not 000-45-6789",
        "plain text with 12 words and 3.14159265358979323846",
    ]
    found = [r["text"] for r in pseudonymous(spark, texts)]
    grouped, plain = found[0].split()[1:5], found[0].split()[6].rstrip(".")
    assert "".join(grouped) == plain != "4539148803436467" and luhn(plain) and plain[0] == "4"
    assert found[1] == texts[1] and found[7] == texts[7]
    octets = found[2][3:-1].split(".")
    assert len(octets) == 4 and all(0 <= int(x) < 256 for x in octets) and found[2] != texts[2]
    _, iso, _, dotted, slashed, _, invalid = found[3].split()
    day = pd.Timestamp(iso)
    assert invalid == "2021-02-29" and iso != "2020-02-29"
    assert slashed == day.strftime("%d/%m/%Y") and dotted == f"{day.day}.{day.month}.{day.year},"
    assert found[4].startswith("call +1 (") and len(found[4]) == len(texts[4])
    assert found[5].endswith("@mail.example.com, thanks") and found[5][8] == "."
    assert found[6].endswith("not 000-45-6789") and found[6] != texts[6]


def test_pseudonyms_link_and_separate(spark):
    texts = [f"ip 10.{i // 250}.{i % 250}.9 x" for i in range(600)] + ["ip 10.1.2.9 x"]
    found = [r["text"] for r in pseudonymous(spark, texts)]
    assert found[-1] == found[252] and len(set(found)) == 600
    assert found != [r["text"] for r in pseudonymous(spark, texts, "other")]
    days = [str(d.date()) for d in pd.date_range("1999-01-01", periods=700)]
    assert len({r["text"] for r in pseudonymous(spark, days)}) == 700


def drawn(key: str, kind: str, step: int, other) -> str:
    return hashlib.sha256("|".join([key, kind, str(step), str(other)]).encode()).hexdigest()


def plain_pair(high: int, low: int, m: int, n: int, key: str, kind: str) -> tuple[int, int]:
    for step in range(1, 9):
        if step % 2:
            high = (high + int(drawn(key, kind, step, low)[:12], 16)) % m
        else:
            low = (low + int(drawn(key, kind, step, high)[:12], 16)) % n
    return high, low


def plain_letters(text: str, key: str, kind: str) -> str:
    def moved(own, other, step):
        stream, out = drawn(key, kind, step, other), ""
        for i, x in enumerate(own):
            v = int(stream[4 * (i % 16) : 4 * (i % 16) + 4], 16) + i // 16
            for first, size in (("0", 10), ("a", 26), ("A", 26)):
                if 0 <= ord(x) - ord(first) < size:
                    x = chr(ord(first) + (ord(x) - ord(first) + v) % size)
                    break
            out += x
        return out

    one, two = text[: len(text) // 2], text[len(text) // 2 :]
    for step in range(1, 9):
        if step % 2:
            one = moved(one, two, step)
        else:
            two = moved(two, one, step)
    return one + two


def plain_luhn(body: str) -> str:
    return next(x for x in "0123456789" if luhn(body + x))


def test_pseudonyms_equal_plain_networks_and_lead_back(spark):
    """A thousand values of each kind, by networks written anew, and back again."""
    draw, first = random.Random(8), pd.Timestamp("1900-01-01")
    texts, wanted = [], []
    for _ in range(1_000):
        o = [draw.randrange(256) for _ in range(4)]
        a, b = plain_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65_536, 65_536, "k", "ip")
        texts.append(".".join(map(str, o)))
        wanted.append(f"{a // 256}.{a % 256}.{b // 256}.{b % 256}")
        day = draw.randrange(17 * 4_297)
        a, b = plain_pair(day // 4_297, day % 4_297, 17, 4_297, "k", "date")
        texts.append(str((first + pd.Timedelta(days=day)).date()))
        wanted.append(str((first + pd.Timedelta(days=a * 4_297 + b)).date()))
        area, group, serial = draw.randrange(898), draw.randrange(99), draw.randrange(9_999)
        a, b = plain_pair(area * 99 + group, serial, 898 * 99, 9_999, "k", "social")

        def social(x, y, z):
            return f"{x + (2 if x >= 665 else 1):03}-{y + 1:02}-{z + 1:04}"

        texts.append(social(area, group, serial))
        wanted.append(social(a // 99, a % 99, b))
        number = "".join(draw.choices("0123456789", k=10))
        code = draw.choice(["1", "44", "420", "7", "49"])
        texts.append(f"+{code}{number}")
        wanted.append(f"+{code}" + plain_letters(number, "k", "phone"))
        card = "4" + "".join(draw.choices("0123456789", k=14))
        texts.append(card + plain_luhn(card))
        body = card[0] + plain_letters(card[1:], "k", "card")
        wanted.append(body + plain_luhn(body))
        name = "".join(draw.choices("abcXYZ019", k=draw.randint(1, 40)))
        texts.append(f"{name}@Host.example.com")
        wanted.append(plain_letters(name, "k", "email") + "@Host.example.com")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hidden = pseudonyms.with_pseudonyms(df, "k")
    assert [r["text"] for r in hidden.orderBy("doc_id").collect()] == wanted
    back = pseudonyms.with_originals(hidden, spark.createDataFrame([("k",)], "secret string"))
    assert [r["text"] for r in back.orderBy("doc_id").collect()] == texts


def test_compact_phone_numbers_link_with_spaced_ones(spark):
    texts = ["+15551234567", "+1 555 123 4567", "+1 (555) 123-4567", "+442079460958", "+44 20 7946 0958"]
    found = [r["text"] for r in pseudonymous(spark, texts)]
    digits = ["".join(x for x in t if x.isdigit()) for t in found]
    assert digits[0] == digits[1] == digits[2] and digits[3] == digits[4]
    assert found[0].startswith("+1") and found[3].startswith("+44")
    assert not {*found} & {*texts}


def test_no_plan_shows_the_key(spark):
    df = spark.createDataFrame([(1, "at 10.0.255.7!")], "doc_id long, text string")
    found = pseudonyms.with_pseudonyms(df, "very secret")
    found.collect()
    plans = found._jdf.queryExecution().toString()
    assert "very secret" not in plans and "Subquery" in plans


# --- 7: captures ------------------------------------------------------------------------------


def test_captures_lookup(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(captures, "BLOCK_LINES", 7)
    pages = [(i, f"http://h{i % 9}.Example.org/p{i % 40}?q#f", f"body {i % 50}") for i in range(300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder = str(tmp_path / "archive")
    captures.write_archives(df, folder)
    for url in ("http://h4.example.org/p13?q", "http://h0.example.org/p0?q", "http://none.example/"):
        key = captures.url_key(url)
        asked = spark.createDataFrame([(key,)], "key string")
        found = captures.read_records(captures.lookup(spark, folder, asked), folder).collect()
        assert sorted(r["page_id"] for r in found) == [
            i for i, u, _ in pages if captures.url_key(u) == key
        ]
        for r in found:
            newest = max(i for i, _, html in pages if html == f"body {r['page_id'] % 50}")
            assert r["refers_to"] == (None if r["page_id"] == newest else newest)


def test_archives_are_gzip_members(spark, tmp_path):
    import gzip

    df = spark.createDataFrame([(1, "http://a/", "x\r\n\r\ny")], "page_id long, url string, html string")
    captures.write_archives(df, str(tmp_path / "a"))
    (file,) = (tmp_path / "a" / "archives").iterdir()
    data = gzip.decompress(file.read_bytes())
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"x\r\n\r\ny\r\n\r\n")


# --- 8 and 9: native statistics ---------------------------------------------------------------


def test_mixing_meets_its_marginals(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    mix = mixing.Mix(share=0.2, source_power=0.9, lang_power=0.9, rounds=30,
                     topics={"prose": 0.9, "brief": 0.01, "figures": 0.01, "marked": 0.08})
    found = mixing.with_sample(docs, carry=["doc_id", "lang"], mix=mix)
    told = found.toPandas()
    weight = told.n_tokens * told.probability
    assert told.probability.max() < 1
    tokens = told.groupby("lang").n_tokens.sum() ** 0.9
    np.testing.assert_allclose(
        weight.groupby(told.lang).sum() / weight.sum(), tokens / tokens.sum(), rtol=0.02
    )
    assert abs(weight.sum() / told.n_tokens.sum() - 0.2) < 0.002
    assert abs(told.n_tokens[told.kept].sum() / weight.sum() - 1) < 0.25


def test_bounded_mixing_meets_its_marginals_where_cells_are_short(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    told = mixing.with_sample(docs, carry=["doc_id"]).toPandas()
    weight = told.n_tokens * told.probability
    assert told.probability.max() == 1
    assert abs(weight.sum() / told.n_tokens.sum() - 0.8) < 0.001
    found = mixing.marginals(docs).toPandas()
    assert (found.wanted > found.base).any() and (found.target <= found.base + 1e-6).all()
    np.testing.assert_allclose(found.reached, found.target, rtol=0.05)
    for _, one in found.groupby("dimension"):
        assert abs(one.reached.sum() / one.target.sum() - 1) < 0.001
        # What short values lack goes to the others by their weights.
        free = one[one.target < one.base * (1 - 1e-9)]
        np.testing.assert_allclose(free.target / free.wanted, (free.target / free.wanted).iloc[0])
    short = mixing.marginals(docs, bounded=False).toPandas()
    assert short.reached.sum() < 0.95 * short.target.sum()


def test_base_statistics(spark):
    texts = [t for _, t in documents()] + odd_texts(200)
    texts += ["a a a a", "a b", "x\nx\n \nx", " \x0b\x0c", "a b c a b c a b", None, "f f\tf\rf f"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = outliers.with_statistics(df).select("doc_id", *outliers.BASE)
    assert [r[1:] for r in rows(found)] == [brute.base_statistics(t) for t in texts]


def test_outliers_by_quality_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op9_quality_outliers(spark, sf).where("not base_failed")
    told = found.join(queries.table(spark, sf, "labels"), "doc_id").toPandas()
    assert told.kept[told.quality == 1].mean() > 0.97
    assert told.kept[told.quality == 0].mean() < 0.1


def test_repetitive_texts_that_pass_the_base_rule_go(spark):
    docs = queries.table(spark, "/root/testdata/sf0.1", "documents")
    # 60 words of a document in one line, and 28 lines of two words, nearly half of all words.
    words = F.slice(F.array_distinct(F.filter(F.split("text", r"\s+"), lambda x: x != "")), 1, 60)
    planted = (
        docs.where("pmod(xxhash64(doc_id), 40) = 0")
        .withColumn("words", words)
        .where("size(words) = 60")
        .select((-1 - F.col("doc_id")).alias("doc_id"), "lang", "source", F.concat(
            F.array_join("words", " "), F.lit("\nread more" * 28)).alias("text"))
    )
    both = docs.select(planted.columns).unionByName(planted)
    told = outliers.with_verdicts(both, carry=["doc_id"]).where("doc_id < 0").toPandas()
    assert len(told) > 100 and not told.base_failed.any()
    assert told.kept.mean() < 0.05
    # The range of either share can pass the cutoff alone, the other statistics at the centre.
    limits = outliers.Limits()
    for most, floor in ((1.0, limits.floors[2]), (0.5**0.5, limits.floors[3])):
        assert (most / floor) ** 2 > limits.cutoff


# --- 10: decontamination ----------------------------------------------------------------------


def test_decontamination_equals_alignment(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 16)
    draw = random.Random(9)
    letters = "abcdefghij éß"
    benchmark = [(i, "".join(draw.choices(letters, k=draw.randint(20, 260)))) for i in range(12)]
    docs = []
    for i in range(60):
        filler = "".join(draw.choices(letters, k=draw.randint(0, 200)))
        passage = list(draw.choice(benchmark)[1])
        for _ in range(draw.randint(0, 5)):
            at = draw.randrange(len(passage))
            passage[at : at + draw.randint(0, 1)] = draw.choices(letters, k=draw.randint(0, 1))
        docs.append((i, filler + ". " + "".join(passage).upper() + " " + filler))
    budget = decontaminate.Budget()
    wanted = []
    for i, text in docs:
        held = brute.normal(text)
        wanted.append((i, sorted(
            item for item, found in benchmark
            if any(brute.fits(w, held, budget.edits(len(w)))
                   for w in decontaminate.windows(brute.normal(found), budget))
        )))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(benchmark, "item_id long, text string")
    found = decontaminate.with_items(df, items).select("doc_id", "items")
    assert rows(found) == wanted
    assert 5 < sum(bool(x) for _, x in wanted) < 60


def test_q_grams_tell_places_apart():
    data = np.frombuffer(b"abcabcabd" * 3, np.uint8)
    for q in (5, 8, 12):
        found = decontaminate.q_grams(data, q)
        texts = [data[i : i + q].tobytes() for i in range(len(data) - q + 1)]
        assert len(found) == len(texts) and len(set(found.tolist())) == len(set(texts))
