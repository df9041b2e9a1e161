"""The operators against plain versions and round trips, on small fixtures with awkward rows."""

from __future__ import annotations

import io
import random
import sys
import zipfile
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.llm import chat, decontam, jaccard, langid, licences, packing, quality, substring, toxicity, warc, wordhash as wh

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, row int, key string, n_words int"  # the last three names clash with ours


def prose(seed: int, n: int, words: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def texts() -> list[str | None]:
    long = prose(1, 300)
    near = long.replace(long.split()[150], "changed", 1)
    rare = [prose(s, 60, 10**6) for s in range(2, 8)]
    passage = prose(50, 60, 10**6)
    return [
        long, long, near, near + " tail", long.replace(" ", "\n\t"), None, "", "   ", "one", "one two three",
        "one two three", *rare, f"{rare[0]} {passage} {rare[1]}", f"{passage} {rare[2]}", "ab " * 120, "ab cd " * 90,
        "Größe ÉTÉ straße " * 20, prose(9, 20_000, 10**6), passage.upper(), "x" * 5000,
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "k", 7) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows + rows[:1], DOCS).repartition(3)


@pytest.fixture(scope="module")
def plain(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("most", [1 << 20, 100])  # one block, and one block per item
def test_contamination(spark, docs, plain, monkeypatch, most):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", most)
    monkeypatch.setattr(decontam, "KEPT_BLOCKS", 4 if most > 100 else 2)
    monkeypatch.setattr(decontam, "GROUP_BYTES", 1 << 25 if most > 100 else 3000)
    base = texts()
    items = [(1, " ".join(base[0].split()[40:90])), (2, base[11].upper()), (3, "one two"), (4, None), (5, ""), (6, base[11])]
    benchmark = spark.createDataFrame(items + items[:1], "item_id long, text string")
    expected = sorted(brute.contamination(plain, items))
    got = [
        (r["row"]["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), brute.sha(",".join(sorted(r["items"]))), r["bad"])
        for r in decontam.scan(docs, benchmark).withColumn("bad", decontam.contaminated()).collect()
    ]
    assert sorted(got) == expected
    kept = decontam.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(e[0] for e in expected if not e[5])


def test_items_without_an_id(spark):
    """They hit words beside other items, but have no name."""
    words = prose(8, 40, 10**6).split()
    docs = spark.createDataFrame([(1, " ".join(words)), (2, None)], "doc_id long, text string")
    items = [(None, " ".join(words[:15])), ("b", " ".join(words[10:30])), (None, None), ("c", None)]
    first, second = decontam.scan(docs, spark.createDataFrame(items, "item_id string, text string")).orderBy("row.doc_id").collect()
    assert (first["n_hit"], first["items"], second["n_hit"]) == (30, ["b"], 0)
    assert sorted((m["item_id"] or "", m["length"]) for m in first["matches"]) == [("", 15), ("b", 20)]
    kept = decontam.decontaminate(docs, spark.createDataFrame(items[:1], "item_id string, text string"))
    assert [r["doc_id"] for r in kept.collect()] == [2]


def test_longest_match(spark):
    words = prose(3, 60, 10**6).split()
    rows = spark.createDataFrame([(1, "a b " + " ".join(words[10:40]) + " c")], "doc_id long, text string")
    benchmark = spark.createDataFrame([("x", " ".join(words))], "item_id string, text string")
    (match,) = decontam.scan(rows, benchmark).first()["matches"]
    assert (match["item_word"], match["doc_word"], match["length"]) == (10, 2, 30)


@pytest.mark.parametrize("buckets", [1, 7])
def test_repeats(docs, plain, buckets):
    found = substring.remove_repeats(docs, buckets=buckets).collect()
    got = sorted((r["row"]["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found)
    assert got == sorted(brute.repeats(plain))


def test_similar_groups(docs, plain):
    found = jaccard.similar_groups(docs).collect()
    expected = sorted(brute.components(plain))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == expected
    kept = sorted(r["doc_id"] for r in jaccard.first_of_groups(docs).collect())
    assert kept == sorted({c for _, n, c in expected if n} | {d for d, n, _ in expected if not n})


def test_many_near_copies(spark):
    base = prose(20, 80, 10**6).split()
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in jaccard.similar_groups(frame).collect()} == {0}


def test_a_family_whose_members_are_only_partly_close(spark, monkeypatch):
    """Two words changed in each: a third of all pairs are links, but about as many tests as members suffice."""
    rng = random.Random(77)
    base, rows = prose(21, 100, 10**6).split(), []
    for i in range(1500):
        words = list(base)
        for place in rng.sample(range(100), 2):
            words[place] = f"x{i}y{place}"
        rows.append((i, " ".join(words)))
    tested = []
    verify = jaccard.linked
    monkeypatch.setattr(jaccard, "linked", lambda pairs, sets: tested.append(pairs.count()) or verify(pairs, sets))
    found = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(brute.components(rows))
    assert sum(tested) <= 10_000


@pytest.mark.parametrize("tile", [8, 1 << 11])
def test_links_that_a_tile_left_out(spark, monkeypatch, tile):
    """Families whose members are about as often just linked as just not, in tiles that do not hold them whole."""
    for name, value in (("TILE", tile), ("CROWD", 3), ("PAIRS_AT_ONCE", 100), ("TILE_BYTES", 1 << 14)):
        monkeypatch.setattr(jaccard, name, value)
    rng, rows = random.Random(78), []
    for family in range(6):
        base = prose(100 + family, 60 + 10 * family, 10**6).split()
        for i in range(40):
            words = list(base)
            for place in rng.sample(range(len(base)), 2):
                words[place] = f"x{i}"
            rows.append((len(rows), " ".join(words)))
    found = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(brute.components(rows))


def test_bit_sketches_bound_the_difference():
    rng = np.random.default_rng(0)
    for n in (5, 60, 700):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        for kept in (0.95, 0.9, 0.85, 0.5):
            b = np.unique(np.concatenate([a[: int(kept * n)], rng.integers(0, 2**63, n // 20, dtype=np.uint64)]))
            bits = pa.array([jaccard.bit_sketches(v, np.array([0, len(v)]))[0] for v in (a, b)], pa.binary())
            close = jaccard.close_pairs(bits, np.array([len(a), len(b)]), np.array([0, 1]), np.array([1, 0]))
            assert close.all() if jaccard.similar(a, b) else close[0] == close[1]


def test_quality_rules(spark, docs):
    found = {r["doc_id"]: r for r in quality.measure(docs).collect()}
    assert found[5]["base_failed"] and found[6]["n_words"] == 0 and not found[7]["kept"]
    assert found[0]["n_words"] == 300 and found[0]["n_repeat_words"] == 0
    assert found[19]["n_repeat_words"] == 120 and found[19]["base_failed"]
    assert quality.filter_quality(docs).columns == docs.columns


def test_packing(docs, plain):
    packed = packing.pack(docs, TOKENIZER).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes() for d, t in plain}
    covered, used = {}, {}
    for p in packed:
        mine = ids[p["row"]["doc_id"]]
        assert p["doc_tokens"] == len(mine) // 4
        assert p["ids_crc32"] == zlib.crc32(mine[4 * p["start"] : 4 * (p["start"] + p["length"])])
        covered[p["row"]["doc_id"]] = covered.get(p["row"]["doc_id"], 0) + p["length"]
        used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    times = {d: sum(x == d for x, _ in plain) for d, _ in plain}
    assert covered == {d: times[d] * len(b) // 4 for d, b in ids.items()}
    for parts in used.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 1024


def test_patterns_hold_exactly_the_demand():
    rng = np.random.default_rng(5)
    demand = {int(c): int(n) for c, n in zip(range(1, 257), rng.integers(0, 900, 256))}
    patterns = packing.solve(demand)
    held = {c: sum(p.counts.get(c, 0) * p.times for p in patterns) for c in demand}
    assert held == demand
    assert all(sum(c * n for c, n in p.counts.items()) <= packing.CLASSES for p in patterns)
    ideal = sum(c * n for c, n in demand.items()) / packing.CLASSES
    assert sum(p.times for p in patterns) <= 1.03 * ideal + 2
    assert packing.solve({}) == []


def test_ids_equal_those_of_whole_texts():
    from tokenizers import Tokenizer

    tokenizer, made = Tokenizer.from_file(TOKENIZER), packing.TokenIds(TOKENIZER)
    cases = ["", " ", "a", " a", "a ", "a  b", "a\n b\t c", "it's we'll", "x  y 　z", " \n a", "1 2,3. - --", "ab\n\n cd \n"]
    cases += ["a <|endoftext|> b", "😀é" * 500, "\x00\x85\xa0\u180e\u200b x", "'S 'd'll", " " * 300_000 + "a", "ab" * 150_000]
    cases += [chr(c) + "a" + chr(c) * 2 + "1" for c in range(0, 0x3000, 7)]
    cases += [t for t in texts() if t]
    assert made.ranks is not None
    for case in cases:
        assert made.of(case) == np.array(tokenizer.encode(case, add_special_tokens=False).ids, "<u4").tobytes()


def test_other_vocabularies_are_left_to_tokenizers(tmp_path):
    import json

    with open(TOKENIZER, encoding="utf-8") as file:
        vocabulary = json.load(file)
    merges = vocabulary["model"]["merges"]
    merges[0], merges[1] = merges[1], merges[0]
    (tmp_path / "other.json").write_text(json.dumps(vocabulary), encoding="utf-8")
    made = packing.TokenIds(str(tmp_path / "other.json"))
    assert made.ranks is None
    assert np.frombuffer(made.of("the cat"), "<u4").tolist() == made.tokenizer.encode("the cat", add_special_tokens=False).ids


def test_chat_round_trip(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [
        (1, 0, "user", said), (1, 1, "assistant", said), (2, 1, "assistant", "<|end|><|turn|>user<|text|> é 😀 "), (2, 0, "system", None),
        (2, 2, "assistant", ""), (3, 0, None, " lead"), (None, 0, "assistant", "x" * 3000), (2, 1, "assistant", "<|end|><|turn|>user<|text|> é 😀 "),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(frame, TOKENIZER)).collect()}
    assert len(found) == 4
    for conv, got in found.items():
        mine = sorted((t, r or "", x or "") for c, t, r, x in rows if c == conv)
        assert got["n_turns"] == len(mine)
        assert got["turns_sha256"] == brute.sha("".join(f"{r}\n{x}\n" for _, r, x in mine))
        loss = "".join(x for _, r, x in mine if r == "assistant")
        assert (got["loss_chars"], got["loss_sha256"]) == (len(loss), brute.sha(loss))


def test_archives(spark):
    big = "<p>" + "same " * 40
    rows = [(5, "u", big), (3, "u\r\nX: 1", big), (9, None, big), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "é", "é" * 60), (3, "v", big)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(frame).collect())
    kinds = {5: ("revisit", 3), 9: ("revisit", 3)}
    expected = sorted((i, len((h or "").encode()), brute.sha(h or ""), *kinds.get(i, ("response", None))) for i, _, h in rows)
    assert got == expected
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_ranges_of_archives_are_read_by_tasks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_RECORDS", 7)
    long = "x" * 300_000
    rows = [(i, f"http://host{i % 3}.example.com:80/p/{i}", f"page {i} " * 20) for i in range(40)] + [(None, "no address", long), (40, None, long)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    ranges = warc.write(frame, warc.new_folder(spark, "warc"))
    back = warc.read(ranges)
    assert back.rdd.getNumPartitions() == ranges.count() >= 42 // 7
    got = {r["record_id"]: (r["url"], bytes(r["payload"]).decode()) for r in back.collect()}
    assert got == {str(i) if i is not None else None: (u or "", h) for i, u, h in rows}


def test_records_are_what_other_readers_expect():
    payload = "<p>é".encode()
    date = "2024-05-06T07:08:09Z"
    first = warc.record(1, "http://a.example/x", payload, "d", None, date)
    again = warc.record(2, "http://a.example/y", payload, "d", 1, date)
    for raw, kind in ((first, "response"), (again, "revisit")):
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and fields["WARC-Type"] == kind and fields["WARC-Date"] == date
        assert fields["Content-Type"] == "application/http; msgtype=response" and fields["WARC-Record-ID"].startswith("<urn:")
        block = rest[: int(fields["Content-Length"])]
        assert rest[len(block) :] == b"\r\n\r\n" and block.startswith(b"HTTP/1.1 200 OK\r\n")
        assert block.partition(b"\r\n\r\n")[2] == (payload if kind == "response" else b"")
    assert fields["WARC-Profile"].endswith("/revisit/identical-payload-digest") and fields["WARC-Refers-To"] == "<urn:page:1>"
    out = io.BytesIO()
    warc.write_archive(out, iter([("http://b.a.example/z", "d", "response", first), ("http://a.example/x", "d", "revisit", again)]), date)
    with zipfile.ZipFile(io.BytesIO(out.getvalue())) as package:
        lines = package.read(warc.INDEX).decode().splitlines()
        assert [line.split(" ")[:2] for line in lines] == [["example,a)/x", "20240506070809"], ["example,a,b)/z", "20240506070809"]]
        assert package.infolist()[0].compress_type == zipfile.ZIP_STORED


class Bytes:
    def __init__(self, data):
        self.data, self.size = data, len(data)

    def read(self, start, length):
        return self.data[start : start + length]


@pytest.mark.parametrize("members", [3, 70_000])  # more than 65,535 need the ZIP64 directory
def test_central_directory(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
        for i in range(members):
            package.writestr(f"m{i}", b"%d" % i)
        with package.open("big", "w", force_zip64=True) as member:
            member.write(b"payload")
        package.writestr("packed", b"z" * 100, zipfile.ZIP_DEFLATED)
    source = Bytes(out.getvalue())
    found = warc.central_directory(source)
    assert len(found) == members + 1 and "packed" not in found
    assert source.read(*found["big"]) == b"payload" and source.read(*found["m2"]) == b"2"


def test_disguised_words_are_restored():
    counts = np.zeros((27, 27, 27))
    for word in "the idiot was stupid and this stupid idiot is a loser with a good book".split() * 50:
        codes = [0, 0, *(ord(c) - 96 for c in word), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            counts[a, b, c] += 1
    reader = toxicity.Reader(counts)
    words = reader.words("You 1d10t, s t u p i d and l.o.s.e.r, a stuuupid b00k, id!ot!!! 5tup1d")
    assert {"idiot", "stupid", "loser", "book"} <= words
    assert reader.words("") == set()


@pytest.mark.parametrize(
    "said, word",
    [("you are a i d i o t", "idiot"), ("I a m o r o n", "moron"), ("a s-c-u-m", "scum"), ("b l ö d", "blöd"), ("i/d/i/o/t", "idiot"),
     ("i, d, i, o, t", "idiot"), ("i  d  i  o  t", "idiot"), ("I a m a s c u m", "scum"), ("l.o.s.e.r", "loser")],
)
def test_words_set_apart_after_other_single_letters(said, word):
    counts = np.zeros((27, 27, 27))
    for text in "you are a idiot and i am a moron the scum is a loser i am a scum das ist sehr".split() * 50:
        codes = [0, 0, *(ord(c) - 96 for c in text), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            counts[a, b, c] += 1
    assert word in toxicity.Reader(counts).words(said)


HIDDEN = [
    ("you id iot there", "idiot"), ("so st.up.id of you", "stupid"), ("an id*ot", "idiot"), ("such an \u0456d\u0456\u043et", "idiot"),
    ("one i\u200bdi\u200bot", "idiot"), ("what a s_t_u_p_i_d", "stupid"), ("st upppid", "stupid"), ("lo.$3r", "loser"), ("a lo\uff53er", "loser"),
]


def english_counts() -> np.ndarray:
    counts = np.zeros((27, 27, 27))
    said = "the idiot was stupid and this stupid idiot is a loser with a good book you are there so what one such of an a i"
    for word in said.split() * 50:
        codes = [0, 0, *(ord(c) - 96 for c in word), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            counts[a, b, c] += 1
    return counts


@pytest.mark.parametrize("said, word", HIDDEN)
def test_words_hidden_across_signs(said, word):
    finder, reader = toxicity.Finder(["idiot", "stupid", "loser"]), toxicity.Reader(english_counts())
    assert word in reader.words(said, finder)


@pytest.mark.parametrize("said", ["he said iota of it", "a good book", "is loose rope there", "an idol", "", "st. upper idaho", "***", "so low"])
def test_nothing_is_hidden_in_plain_texts(said):
    finder, reader = toxicity.Finder(["idiot", "stupid", "loser"]), toxicity.Reader(english_counts())
    assert not reader.words(said, finder) & {"idiot", "stupid", "loser"}


def test_the_lattice_finds_the_cheapest_of_all_readings():
    import itertools

    reader, rng = toxicity.Reader(english_counts()), random.Random(1)

    def cost(letters):
        codes = [0, 0, *(ord(c) - 96 if "a" <= c <= "z" else 0 for c in letters), 0]
        return sum(reader.costs[x] for x in zip(codes, codes[1:], codes[2:]))

    for _ in range(60):
        stretch = "".join(rng.choice("id1o0t $.ss") for _ in range(rng.randrange(1, 7)))
        choices = [reader._choices(m[0][0], len(m[0])) for m in toxicity.re.finditer(r"(.)\1*", stretch)]
        paths = [("".join(t for t, _ in path), sum(p for _, p in path)) for path in itertools.product(*choices)]
        best = min(cost(said) + price for said, price in paths)
        read = reader.best(choices)
        assert min(cost(said) + price for said, price in paths if said == read) == pytest.approx(best)


def test_toxicity_finds_the_places_of_letters_without_a_step_for_each():
    finder = toxicity.Finder(["idiot"])
    low = "der abend war schön und lang, " * 2_000 + "you i-d-1ot so on"
    steps = []
    sys.setprofile(lambda frame, event, what: steps.append(event))
    try:
        found = finder.stretches(low)
    finally:
        sys.setprofile(None)
    assert found == {("i-d-1ot", "idiot")}
    assert len(steps) < 1_000  # several for each of 50,000 letters before


def test_toxicity_places_of_letters():
    bare, places = toxicity._with_places("ll 1l\U0001f600 о0Ｏ ａb")
    assert (bare, places.tolist()) == ("ioab", [0, 7, 11, 12])


def test_toxicity_of_long_texts_and_of_one_class(spark):
    rows = [(i, ("you stupid fool " if i % 2 else "a fine day ") + f"w{i}") for i in range(60)]
    rows += [(100, "fine " * 60_000 + "st.up.id"), (101, "fine " * 60_000), (102, None), (103, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    counts = toxicity.trigram_counts(docs)
    model = toxicity.train(docs, labels, "doc_id", "text", "toxic", counts)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, "doc_id", "text").collect()}
    assert "stupid" in model.telling and got[100] > got[101] and got[102] == got[103]
    one = toxicity.train(docs, labels.where("toxic = 1"), "doc_id", "text", "toxic", counts)
    assert toxicity.score(docs, one, "doc_id", "text").count() == len(rows)
    none = toxicity.train(docs.limit(0), labels.limit(0), "doc_id", "text", "toxic", toxicity.trigram_counts(docs.limit(0)))
    assert toxicity.score(docs.limit(0), none, "doc_id", "text").count() == 0


def test_toxicity_learns_from_labels(spark):
    rows = [(i, prose(i, 40, 300) + (" scum" if i % 3 == 0 else "")) for i in range(240)] + [(900, None), (901, ""), (902, "hello s-c-u-m w1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(0, 240, 2)] + [(1, None), (0, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, "doc_id", "text", "toxic", toxicity.trigram_counts(docs))
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model, "doc_id", "text").collect()}
    assert sum((found[i] >= 0.5) == (i % 3 == 0) for i in range(240)) >= 228
    assert found[902] > 0.5 > found[900] == found[901] >= 0


def test_languages(spark):
    samples = {"en": "the quick fox and the lazy dog were there ", "de": "der schnelle Fuchs und die faule Katze sind da ", "fr": "le renard rapide et le chien sont là pour vous "}
    rows = [(i, text * (1 + i % 3), lang) for i, (lang, text) in enumerate(list(samples.items()) * 6)]
    rows += [(100, None, None), (101, "123 !?", "en"), (102, "", None), (103, "und die Katze", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, "doc_id", "text", "lang")
    found = {r["doc_id"]: r for r in langid.predict(docs, model, "doc_id", "text").collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows[:18])
    assert [found[i]["lang_pred"] for i in (100, 101, 102, 103)] == ["und", "und", "und", "de"]
    none = langid.train(docs.limit(0), "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in langid.predict(docs, none, "doc_id", "text").collect()} == {"und"}


def test_licences_are_inherited(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/b/x.py", "# nothing here\ncode"), ("a/b/COPYING.txt", "Licensed under the Apache License, Version 2.0."),
        ("a/c/y.py", None), ("z.py", "nothing"), (None, "nothing"), ("a/b/d/own.py", "# Licensed under CC BY-NC 4.0."), ("a/b/d/e.py", ""),
    ]
    found = {r["path"]: (r["licence"], r["effective"], r["from_path"]) for r in licences.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert found["a/b/x.py"] == (None, "Apache-2.0", "a/b/COPYING.txt")
    assert found["a/b/d/e.py"] == (None, "Apache-2.0", "a/b/COPYING.txt")
    assert found["a/c/y.py"] == (None, "MIT", "a/LICENSE")
    assert found["a/b/d/own.py"] == ("CC-BY-NC-4.0", "CC-BY-NC-4.0", "a/b/d/own.py")
    assert found["z.py"] == found[None] == (None, None, None)


@pytest.mark.parametrize("n", [400, 8000])
def test_a_notice_keeps_its_licence_in_tables_of_any_size(spark, n):
    """Extra words in half of all files weigh little, however many files there are."""
    usual = "'code project copyright software'"
    rows = spark.range(n).select(
        F.concat(F.lit("f"), "id").alias("path"),
        F.when(F.col("id") == 0, "Copyright project software. This code: Released under the MIT License.")
        .when(F.col("id") % 2 == 0, F.expr(usual)).otherwise(F.concat(F.lit("prose w"), "id")).alias("text"),
    )
    found = licences.file_licences(rows).where("licence is not null").collect()
    assert [(r["path"], r["licence"]) for r in found] == [("f0", "MIT")]
    assert found[0]["score"] >= 0.8


def test_whole_texts_tags_titles_and_wrapped_notices(spark):
    texts = {f.name.removesuffix(".txt"): f.read_text() for f in licences.TEXTS.glob("*.txt")}
    prose_ = " ".join(f"word{i}" for i in range(3000))
    rows = [(f"{name}/LICENSE", f"Copyright (c) 2020 Jane Doe\n\n{text}", name) for name, text in texts.items()]
    rows += [
        ("title/LICENSE", "MIT License\n\nCopyright (c) 2020 Foo", "MIT"),
        ("tag.py", "# SPDX-License-Identifier: MIT\nimport os", "MIT"),
        ("later.py", "/* SPDX-License-Identifier: GPL-2.0-or-later */\nint a;", "GPL-2.0"),
        ("either.rs", "// SPDX-License-Identifier: MIT OR Apache-2.0\nfn a() {}", "MIT OR Apache-2.0"),
        ("wrapped.py", "# This work is licensed\n# under the GNU General\n# Public License, version 2\nimport os", "GPL-2.0"),
        ("long.txt", f"{prose_} Released under the MIT License {prose_}", "MIT"),
        ("head.c", "/*\n" + "\n".join(f" * {x}" for x in texts["MIT"].splitlines()) + "\n */\nint main() { return 0; }", "MIT"),
        ("two.c", "/*\n" + texts["BSD-2-Clause"] + "*/\nint main() { return 0; }", "BSD-2-Clause"),
        ("none.txt", "The library was licensed to sell food under a public scheme.", None),
        ("markdown/LICENSE", "All rights reserved. Ask us first.", None),
    ]
    rows += [(f"other{i}.txt", f"the use of this and of that in any software, with or without a word{i}", None) for i in range(100)]
    found = licences.file_licences(spark.createDataFrame(rows, "path string, text string, expected string"))
    got = {r["path"]: (r["licence"], r["row"]["expected"]) for r in found.collect()}
    assert {p: x for p, x in got.items() if x[0] != x[1]} == {}


def test_an_unrecognised_licence_file_is_not_skipped(spark):
    rows = [
        ("LICENSE", "Licensed under the Apache License, Version 2.0"), ("vendor/x/LICENSE", "All of this is ours."), ("vendor/x/src/a.c", "int a;"),
        ("vendor/y.c", "int y;"), ("both/COPYING", "Ours too."), ("both/LICENSE", "Released under the MIT License"), ("both/b.c", "int b;"),
        ("none/LICENSE", None), ("none/c.c", "int c;"),
    ]
    found = {r["path"]: (r["licence"], r["effective"], r["from_path"]) for r in licences.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert found["vendor/x/src/a.c"] == found["vendor/x/LICENSE"] == (None, "unknown", "vendor/x/LICENSE")
    assert found["vendor/y.c"] == (None, "Apache-2.0", "LICENSE")
    assert found["both/b.c"] == (None, "MIT", "both/LICENSE")
    assert found["none/c.c"] == (None, "unknown", "none/LICENSE")


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontam.scan(none, benchmark).count() == 0 and decontam.scan(docs, benchmark).where("n_hit > 0").count() == 0
    assert substring.remove_repeats(none).count() == 0
    assert jaccard.similar_groups(none).count() == 0
    assert quality.measure(none).count() == 0
    assert packing.pack(none, TOKENIZER).count() == 0
    assert langid.train(docs.withColumn("lang", F.lit(None).cast("string")), "doc_id", "text", "lang").languages == []


def test_near_duplicates_send_only_the_sets_in_question_and_a_pair_to_one_block(spark):
    words = prose(3, 80, 10**6)
    said = [words, words.rsplit(" ", 1)[0] + " other", prose(4, 80, 10**6), prose(5, 80, 10**6)]  # 0 and 1 are close
    data, offsets = wh.text_bytes(pa.array(said))
    values, first = jaccard.shingle_sets(data, offsets)
    kind = "struct<c1:bigint,c2:bigint>"
    known = [((i, -i), int(n), bits) for i, (n, bits) in enumerate(zip(np.diff(first), jaccard.bit_sketches(values, first)))]
    members = spark.createDataFrame(known, f"c {kind}, size int, bits binary")
    places = [(7, 0, 2), (7, 1, 2), (7, 2, 2), (5, 0, 2), (5, 1, 2), (5, 3, 2), (3, 0, 2), (3, 2, 2), (9, 0, 0), (9, 1, 1)]
    rows = [(block, 0, 0, side, (i, -i), (i, -i)) for block, i, side in places]
    dealt = spark.createDataFrame(rows, f"block bigint, u int, t int, side int, c {kind}, root {kind}")
    found = sorted((r["block"], r["c"]["c1"]) for r in jaccard.in_question(dealt, members).collect())
    assert found == [(5, 0), (5, 1)]  # not 7 and 9 again; nothing of 3
    joined = dealt.withColumn("root", F.lit(1))  # classes of one group are in no pair
    assert jaccard.in_question(joined, members).count() == 0
