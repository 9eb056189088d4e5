"""Fingerprints, personal data, merge-dropout and HTML against brute force and edge cases."""

import hashlib
import re
import time
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shoplens.llm import pii
from shoplens.llm.common import splitters
from shoplens.llm.fingerprints import fingerprint_documents, likeness, order_minhash
from shoplens.llm.html_main import extract_main_text, main_text
from shoplens.llm.merge_dropout import MergeCache, PairTable, Vocabulary, decode, encode_and_decode, encode_documents
from shoplens.llm.pii import find_personal_data, mask_documents, pattern_probabilities
from tests.llm.fixtures import documents, sentence, texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _key(row):
    return (row[0] is None, row[0] or 0, row[1] or "")


# ---------------------------------------------------------------- fingerprints


def test_fingerprints_and_edits(spark):
    rows = sorted(texts(), key=_key)
    got = fingerprint_documents(documents(spark)).collect()
    assert len(got) == len(rows)
    want = Counter()
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[40]["fingerprint"] == by_id[41]["fingerprint"] and by_id[40]["near_next"] == 1.0
    assert by_id[12]["fingerprint"] == by_id[13]["fingerprint"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert by_id[20]["near_next"] > 0.9 > by_id[22]["near_next"]  # 21 is a near copy of 20


def test_fingerprints_of_empty_and_single_tables(spark):
    assert fingerprint_documents(documents(spark, [])).count() == 0
    (only,) = fingerprint_documents(documents(spark, [(1, "a b c d")])).collect()
    assert only["near_next"] == 1.0  # it is its own next


def _brute_sketch(text, xx, k=3, length=2, sketches=64, orders=4):
    """The same sketches, k-mer by k-mer, from Spark's hash of each numbered k-mer."""
    low28 = 2**28 - 1
    symbols = re.findall(r"[^\s]{1,12}", text, re.A)
    kmers = [tuple(symbols[i : i + k]) for i in range(max(1, len(symbols) - k + 1))]
    seen, coded = Counter(), []
    for place, kmer in enumerate(kmers):
        own = xx(*kmer) & (2**63 - 1)
        coded.append(((xx_long(xx, own, seen[kmer]) & (2**63 - 1)) >> 28, place))
        seen[kmer] += 1
    out = []
    for order in range(orders):
        values = [((xx_long(xx, head, order) & (2**63 - 1)) >> 28, place) for head, place in coded]
        for b in range(sketches // orders):
            start = (2**35 * b) // (sketches // orders)  # of the 35 bits above the place
            mine = sorted(values, key=lambda v: ((v[0] - start) % 2**35, v[1]))[:length]
            acc = 0
            for head, _ in sorted(mine, key=lambda v: v[1]):
                acc = xx_acc(xx, acc, head)
            out.append(acc & 0xFFFFFFFF)
    return out


def xx_long(xx, own, occurrence):
    return xx(("long", own), ("int", occurrence))


def xx_acc(xx, acc, x):
    return xx(("long", acc), ("long", x))


def test_order_minhash_matches_its_definition(spark):
    cache = {}

    def xx(*args):
        if args not in cache:
            cols = [F.lit(a[1]).cast(a[0]) if isinstance(a, tuple) else F.lit(a) for a in args] or [F.lit(None).cast("string")]
            cache[args] = spark.range(1).select(F.xxhash64(*cols).alias("h")).first()["h"]
        return cache[args]

    for text in ("a b c a b c a b c d", "one two", sentence(4, 14)):
        got = spark.createDataFrame([(text,)], "t string").select(order_minhash(F.col("t")).alias("f")).first()["f"]
        assert got == _brute_sketch(text, xx)


def test_fingerprints_see_order(spark):
    a = sentence(9, 80).split()
    rows = [("same", a), ("swapped", a[40:] + a[:40]), ("reversed", a[::-1])]
    df = spark.createDataFrame([(n, " ".join(w)) for n, w in rows], "n string, t string")
    f = {r["n"]: r["f"] for r in df.select("n", order_minhash(F.col("t")).alias("f")).collect()}
    alike = {n: sum(x == y and x is not None for x, y in zip(f["same"], f[n])) for n in f}
    assert alike["same"] > alike["swapped"] > alike["reversed"]


def _likeness_of_pairs(spark, pairs, **options):
    df = spark.createDataFrame(pairs, "a string, b string")
    prints = [order_minhash(F.col(c), **options).alias(c) for c in "ab"]
    return np.array([r["l"] for r in df.select(*prints).select(likeness(F.col("a"), F.col("b")).alias("l")).collect()])


def _short_pairs(words, n):
    """Texts of so many words, different in every pair, and each with one word in the middle replaced."""
    pairs = []
    for i in range(n):
        w = [f"w{i}x{j}" for j in range(words)]
        pairs.append((" ".join(w), " ".join(w[: words // 2] + ["other"] + w[words // 2 + 1 :])))
    return pairs


@pytest.mark.parametrize("words", [12, 20, 60])
def test_rotations_are_as_good_as_independent_orders(spark, words):
    pairs = _short_pairs(words, 300)
    rotated = _likeness_of_pairs(spark, pairs)
    independent = _likeness_of_pairs(spark, pairs, orders=64)
    # no bias: the means agree within their errors
    error = np.sqrt((rotated.var() + independent.var()) / len(pairs))
    assert abs(rotated.mean() - independent.mean()) < 4 * error
    assert 0 < rotated.mean() < 1
    # few k-mers are shared by neighbouring rotations: some more spread, not a multiple of it
    assert rotated.std() < 1.5 * independent.std()


def test_short_texts_have_whole_tuples(spark):
    # two k-mers: every tuple holds both, so their order decides all of them
    pairs = [("a b c d", "a b c d"), ("x y z x y z x", "x y z x y z")]
    same, other = _likeness_of_pairs(spark, pairs)
    assert same == 1.0 and other < 1.0
    df = spark.createDataFrame([(t,) for t in ("a b c d", "one two three four five six", "", "one")], "t string")
    for row in df.select(order_minhash(F.col("t")).alias("f")).collect():
        assert len(row["f"]) == 64 and None not in row["f"]


def test_ranges_do_not_grow_with_the_rows(spark):
    rows = spark.range(5000).withColumnRenamed("id", "_key")
    assert len(splitters(rows, "_key", 10, most=1000)) > 400
    assert len(splitters(rows, "_key", 10, most=16)) == 15


# ---------------------------------------------------------------- personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {
        "email": True,
        "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")),
        "card": 14 <= len(d) <= 19 and _luhn(d),
        "phone": 10 <= len(d) <= 15,
    }[kind]


def brute_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        out += [(m.start(), n, kind, m.end()) for m in re.finditer(pattern, text or "") if _valid(kind, m[0])]
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


AWKWARD = [
    "a@b.c_d@e.f x@y.z.w@q.r",
    "é 1.2.3.4.5 0001.02.3.0255 256.1.1.1 1.2.3 9.9.9.9",
    "4111-1111 1111-1111 4111  1111 1111 1111 " + "7" * 30,
    "+1 (415) 555-2671) ++44 20 7946 0958 +123 +12345678901234567",
    "a" * 30_000 + "@" + "1" * 30_000,
    "1 " * 20_000,
    "+" * 2000 + "1 (" * 2000,
    "中文 ann@mail.example.org 🙂 bob@x.de",
]


def test_base_spans_match_the_plain_patterns(spark):
    rows = texts() + [(1000 + i, t) for i, t in enumerate(AWKWARD)]
    got = {}
    for r in find_personal_data(documents(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, t in rows:
        base = brute_spans(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        for r in got[i]:
            assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), (i, r["spans"], text)
            assert [r[f"n_{k}"] for k in PLAIN] == [sum(x[0] == k for x in base) for k in PLAIN]
            assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))


def test_texts_of_many_matches(spark):
    """More matches than a block holds, at places that code points and bytes count differently."""
    parts = [f"é{'x' * (k % 7)} user{k}@mail{k % 5}.example.com" for k in range(700)]
    text = " ".join(parts) + " 10.0.0.1"
    start = time.process_time()
    found = find_personal_data(documents(spark, [(1, text), (2, ""), (3, None)])).filter("doc_id = 1").first()
    at, spans = 0, []
    for part in parts:
        mail = part.split(" ")[1]
        spans.append(f"email:{at + len(part) - len(mail)}:{at + len(part)}")
        at += len(part) + 1
    spans.append(f"ip:{at}:{at + 8}")
    assert found["n_email"] == 700 and found["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
    assert time.process_time() - start < 60


def test_credentials_are_added_and_clean_texts_left_alone(spark):
    rows = [(i, f"{sentence(i, 20)} password={'ab12cd34ef' + str(i)} {sentence(i, 5)}") for i in range(30)]
    rows += [(100 + i, sentence(i, 40)) for i in range(30)]
    got = {r["doc_id"]: r["spans"] for r in find_personal_data(documents(spark, rows)).collect()}
    assert all(got[i].startswith("secret:") for i in range(30))
    assert all(got[100 + i] == "" for i in range(30))


def test_em_finds_the_unreliable_labeler():
    counts = {(1, 1, 2, 1, 1): 80.0, (1, 1, 2, 1, 0): 75.0, (0, 0, 2, 0, 1): 82.0, (0, 0, 2, 0, 0): 78.0}
    posterior, rates = pattern_probabilities(counts)
    assert posterior[(1, 1, 2, 1, 0)] > 0.95 and posterior[(0, 0, 2, 0, 1)] < 0.05
    assert abs(rates[4][0] - rates[4][1]) < 0.1 < rates[0][0] - rates[0][1]


def test_masking_keeps_columns_and_clean_texts(spark):
    docs = documents(spark)
    got = {r["doc_id"]: r for r in mask_documents(docs).collect()}
    assert mask_documents(docs).columns == docs.columns
    assert got[24]["text"] == "Write to [EMAIL] or call [PHONE], card [CARD]."
    assert got[12]["text"] is None and got[40]["text"] == dict(texts())[40]
    assert mask_documents(documents(spark, [])).count() == 0


def test_personal_data_of_empty_table(spark):
    assert find_personal_data(documents(spark, [])).count() == 0
    assert pii.train_spans(documents(spark, [])).priors == [0.0] * len(pii.KINDS)


# ---------------------------------------------------------------- merge-dropout


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(MODEL)


def test_without_dropout_the_ids_are_the_librarys(vocabulary):
    cache = MergeCache(vocabulary, 1, 0, 0.0)
    for _, t in texts():
        assert list(array("I", cache.encode(t or ""))) == vocabulary.processor.encode(t or "")
    for t in (" lead", "two  spaces", "tail ", "\nline\n\nline", "a\tb", "don't.", "x!!", "́"):
        assert list(array("I", cache.encode(t))) == vocabulary.processor.encode(t), t


def test_every_text_decodes_to_itself(vocabulary):
    for rate in (0.0, 0.1, 0.5, 1.0):
        cache = MergeCache(vocabulary, 7, 1, rate)
        for t in [t or "" for _, t in texts()] + ["▁mark ▁▁", "\u0000", "🙂 ok"]:
            assert decode(vocabulary, list(array("I", cache.encode(t)))) == t.encode()


def test_dropout_is_keyed(vocabulary):
    t = sentence(3, 200)
    a, b = MergeCache(vocabulary, 7, 0, 0.2), MergeCache(vocabulary, 7, 0, 0.2)
    other = MergeCache(vocabulary, 8, 0, 0.2)
    assert a.encode(t) == b.encode(t) != other.encode(t)
    small = MergeCache(vocabulary, 7, 0, 0.2, limit=5)  # forgetting changes nothing
    assert small.encode(t) == a.encode(t)
    plain = MergeCache(vocabulary, 7, 0, 0.0)
    assert len(a.encode(t)) > len(plain.encode(t))


def plain_ids(segments, k):
    return segments.ids[segments.starts[k] : segments.starts[k] + segments.sizes[k]].tolist()


def test_occurrences_of_a_word_vary(vocabulary):
    cache, plain = MergeCache(vocabulary, 7, 0, 0.1), MergeCache(vocabulary, 7, 0, 0.0)
    word = "understanding"
    ways = Counter()
    for k in range(40):
        text = f"start{k} " + " ".join([word] * 200)
        ids = list(array("I", cache.encode(text)))
        assert decode(vocabulary, ids) == text.encode()
        pieces = [vocabulary.surface[i] for i in ids]
        at = [i for i, p in enumerate(pieces) if p[:1] == b" "] + [len(ids)]
        ways.update(tuple(ids[a:b]) for a, b in zip(at, at[1:]) if b"".join(pieces[a:b]) == b" " + word.encode())
    assert len(ways) > 10
    # a part is whole if none of its pops is skipped
    found = plain.free(["▁" + word])
    share, pops = ways[tuple(plain_ids(found, 0))] / sum(ways.values()), int(found.pops[0])
    assert share >= 0.9**pops - 0.03


def plain_agenda(vocabulary, part, h, rate):
    """Ids of one part by a list of symbols: the best pair (then the left one) is popped, its draw looked up."""
    processor, mask = vocabulary.processor, 2**64 - 1
    symbols, skipped, pop = list(part), set(), 0
    while True:
        pairs = [
            (-processor.get_score(vocabulary.ids[x + y]), k)
            for k, (x, y) in enumerate(zip(symbols, symbols[1:]))
            if x + y in vocabulary.ids and (k, x, y) not in skipped
        ]
        if not pairs:
            break
        _, k = min(pairs)
        pop += 1
        x = (h + pop * 0xD1B54A32D192ED03) & mask
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        if rate and (x ^ (x >> 31)) <= int(rate * 2**64):
            skipped.add((k, symbols[k], symbols[k + 1]))
            continue
        # a skipped pair is a candidate again only once a neighbour has grown
        skipped = {(i - (i > k), a, b) for i, a, b in skipped if i not in (k - 1, k, k + 1)}
        symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
    out = []
    for symbol in symbols:
        spelled = symbol.replace("\ud800", "▁").encode()
        out += [vocabulary.ids[symbol]] if symbol in vocabulary.ids else [vocabulary.byte_ids[x] for x in spelled]
    return out


@pytest.mark.parametrize("rate", [0.0, 0.15, 0.6])
def test_dropout_matches_a_plain_agenda(vocabulary, rate):
    cache = MergeCache(vocabulary, 5, 1, rate)
    batch = [t or "" for _, t in texts() if len(t or "") < 5000] + ["▁ mark▁▁", "  two  spaces ", "a\n\nb\n", "🙂🙂 中文", "thethethe" * 5]
    for text, raw in zip(batch, cache.encode_many(batch)):
        parts = vocabulary.parts(text)
        assert "".join(parts).replace("▁", " ").replace("\ud800", "▁") == (" " + text if text else "")
        h = cache.hashes([text], np.array([len(parts)])).tolist() if parts else []
        expected = [i for part, x in zip(parts, h) for i in plain_agenda(vocabulary, part, x, rate)]
        assert list(array("I", raw)) == expected, text[:80]


def test_the_heap_gives_what_arrays_give(vocabulary):
    cache = MergeCache(vocabulary, 5, 1, 0.3)
    parts = vocabulary.parts(sentence(8, 300) + " 🙂 中文文本 " + "ab" * 20)
    h = cache.hashes(["x"], np.array([len(parts)]))
    found = cache.segment(parts, h)
    for k, (part, x) in enumerate(zip(parts, h.tolist())):
        symbols, points, n = cache.by_heap(part, x)
        assert vocabulary.ids_of(symbols, points)[0].tolist() == plain_ids(found, k) and n == found.pops[k]


def test_very_long_parts_are_encoded_whole(vocabulary):
    for rate in (0.0, 0.1):
        cache = MergeCache(vocabulary, 5, 1, rate)
        for long in ("x" * 20_000, "的" * 5_000, " " * 9_000):
            ids = list(array("I", cache.encode(long)))
            assert decode(vocabulary, ids) == long.encode()
            assert rate or ids == vocabulary.processor.encode(long)


def test_the_pair_table_holds_every_pair(vocabulary):
    keys = list(vocabulary.merged)
    left, right = (np.array(x, dtype=np.int32) for x in zip(*keys))
    assert vocabulary.pairs.get(left, right).tolist() == list(vocabulary.merged.values())
    others = [(a, b) for a, b in zip(right.tolist(), left.tolist()) if (a, b) not in vocabulary.merged]
    left, right = (np.array(x, dtype=np.int32) for x in zip(*others))
    assert (vocabulary.pairs.get(left, right) == vocabulary.size).all()
    assert PairTable({}, vocabulary.size).get(left[:3], right[:3]).tolist() == [vocabulary.size] * 3
    wide = PairTable(vocabulary.merged, 1 << 20)  # more symbols than 32-bit keys can hold
    left, right = (np.array(x, dtype=np.int32) for x in zip(*keys))
    assert wide.get(left, right).tolist() == list(vocabulary.merged.values())


def test_merge_dropout_on_spark(spark, vocabulary):
    got = encode_and_decode(documents(spark), MODEL).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in texts())
    assert all(r["lossless"] for r in got)
    for r in encode_documents(documents(spark), MODEL).collect():
        raw = MergeCache(vocabulary, 17, r["variant"], 0.1)
        match = [t for i, t in texts() if i == r["doc_id"]][0]
        assert array("I", r["ids"]).tobytes() == raw.encode(match or "")
    assert {(r["doc_id"], r["decoded_crc32"]) for r in got} == {(i, zlib.crc32((t or "").encode())) for i, t in texts()}
    assert encode_and_decode(documents(spark, []), MODEL).count() == 0


# ---------------------------------------------------------------- HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav>
<div class="cookie-notice">We use cookies, a long long sentence about cookies and partners and consent.</div>
<div id="wrap"><div class="ad">Buy this wonderful thing today, it is a very long advert text indeed.</div>
<article><header><h1>Title &amp; more</h1></header><p>First   paragraph of the article with <b>bold</b> words &eacute; and enough text.
<p>Second paragraph, unclosed, also long enough to matter here.<br>After the break<ul><li>point one<li>point two</ul>
<p>Short.</p><form><label>Mail</label><input name=x><button>Send</button></form>
<div class="comments"><p>A reader writes a really long comment about the article and its many faults.</p></div></article>
<aside><p>Sidebar text that is long enough to look like content to a naive reader.</p></aside></div>
<footer>&copy; site</footer></body></html>"""


def test_article_without_boilerplate():
    assert main_text(PAGE) == (
        "Title & more\nFirst paragraph of the article with bold words é and enough text.\n"
        "Second paragraph, unclosed, also long enough to matter here. After the break\npoint one\npoint two\nShort."
    )


def test_article_without_semantic_elements():
    page = "<body><div class=menu><a>x</a><a>y</a></div><div><p>%s</p><p>%s</p><p>No.</p></div><div id=footer>f</div></body>"
    assert main_text(page % (sentence(1, 30), sentence(2, 30))) == f"{sentence(1, 30)}\n{sentence(2, 30)}\nNo."


def test_uneven_blocks_keep_the_whole_article():
    long = sentence(1, 500)
    rest = f"Title\nshort one\n{long}\nshort two"
    for a, b in (("<blockquote>", "</blockquote>"), ("<blockquote><p>", "</p></blockquote>"), ("<pre>", "</pre>"),
                 ("<section>", "</section>"), ("<div>", "</div>"), ("<ul><li>", "</ul>"), ("<table><tr><td>", "</table>")):
        page = f"<body><div class=menu><a>x</a></div><div><h1>Title</h1><p>short one</p>{a}{long}{b}<p>short two</p></div></body>"
        assert main_text(page) == rest, a
    sections = f"<div><section><h2>A</h2><p>{long}</p></section><section><h2>B</h2><p>short</p></section></div>"
    assert main_text(sections) == f"A\n{long}\nB\nshort"
    first, second, teaser = sentence(2, 60), sentence(3, 60), sentence(4, 25)
    card = f"<article><p>{teaser}</p></article>"
    assert main_text(f"<main><p>{first}</p><p>{second}</p></main>{card}") == f"{first}\n{second}"
    assert main_text(f"<div><p>{first}</p><p>{second}</p></div><div>{card}</div>").startswith(f"{first}\n{second}")
    posts = f"<div><article><p>{first}</p></article><article><p>{second}</p></article></div>"
    assert main_text(posts) == f"{first}\n{second}"


def test_hints_on_wrappers_do_not_empty_the_page():
    one, two = sentence(1, 60), sentence(2, 60)
    for body in (f"<p>{one}</p><p>{two}</p>", f"<article><p>{one}</p><p>{two}</p></article>"):
        inner = f"<div class=menu><a>x</a></div><div>{body}</div><div class=sidebar><p>{sentence(5, 12)}</p></div>"
        for start, end in (("<div class='layout with-sidebar'>", "</div>"), ("<div class=no-sidebar>", "</div>"),
                           ("<section class='has-banner'>", "</section>"), ("<div class=content-widget>", "</div>"),
                           ("<div id=page-login>", "</div>"), ("<form>", "</form>")):
            assert main_text(f"<body>{start}{inner}{end}</body>") == f"{one}\n{two}", start
    three = sentence(3, 60)
    flagged = f"<div class=login><p>{one}</p></div><div class=widget><p>{two}</p></div><div class=share><p>{three}</p></div>"
    assert main_text(flagged) == f"{one}\n{two}\n{three}"
    comments = f"<div class=comments><p>{sentence(6, 90)}</p><p>{sentence(7, 90)}</p></div>"
    assert main_text(f"<article><p>{one}</p></article>{comments}") == one


JUNK = ["<![", "foo[", "]]>", "<!", "<?", "<a <", "<", '"', "'", "--", "cdata", "[", ">", "=", "/>", "&#x;", "&#99999999;",
        "\x00", "<![if IE]>", "<![CDATA[", "<!DOCTYPE", "<div>", "</div>", "<p>", "text ", "</article>", "<article class='ad'>"]


def test_no_markup_stops_the_parser():
    rng = np.random.default_rng(2)
    for _ in range(5000):
        main_text("".join(JUNK[k] for k in rng.integers(0, len(JUNK), rng.integers(0, 30))))
    assert main_text("<![foo[bar]]><p>text</p>") == "text"
    assert main_text("<p>text</p><a href=") == "text"


def test_deep_and_broken_pages_take_linear_time():
    start = time.process_time()
    assert main_text("<div>word " * 20_000) == "\n".join(["word"] * 20_000)
    assert main_text("<div>" * 20_000 + "words") == "words"
    assert main_text("<p>text</p>" + "<a <" * 20_000) == "text"
    assert time.process_time() - start < 10


def generated_page(rng):
    """A page of a random layout and the text of its article."""
    def words(n):
        return " ".join(f"w{k}" for k in rng.integers(0, 999, n))

    blocks = [words(rng.integers(25, 60)) for _ in range(rng.integers(3, 9))]
    body = "".join(rng.choice(["<p>{}</p>", "<p>{}</p>\n", "<blockquote>{}</blockquote>", "<h2>{}</h2>"]).format(b) for b in blocks)
    links = "".join(f"<li><a href='/{k}'>{words(2)}</a></li>" for k in range(rng.integers(2, 9)))
    side = [f"<nav><ul>{links}</ul></nav>", f"<div class='sidebar'><ul>{links}</ul></div>", f"<aside>{words(8)}</aside>",
            f"<form><input><button>{words(2)}</button></form>", f"<div id='cookie-notice'>{words(12)}</div>",
            f"<section class='comments'><p>{words(9)}</p></section>", f"<script>var x = '{words(5)}';</script>"]
    extra = ["".join(rng.choice(side, rng.integers(0, 4)).tolist()) for _ in range(2)]
    wrap = str(rng.choice(["<article>{}</article>", "<main>{}</main>", "<div><div>{}</div></div>", "<div class='post'>{}</div>"]))
    for _ in range(rng.integers(0, 4)):
        wrap = f"<div>{wrap}</div>"
    page = f"<html><body><header>{words(3)}</header>{extra[0]}{wrap.format(body)}{extra[1]}<footer>{words(6)}</footer></body></html>"
    return page, "\n".join(blocks)


def test_generated_pages_give_their_article():
    rng = np.random.default_rng(6)
    for _ in range(300):
        page, text = generated_page(rng)
        assert main_text(page) == text, page


def test_pages_on_spark(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "plain text only"), (4, "u", "plain text only"),
            (None, "u", "<nav>only menu</nav>"), (6, "u", "<p>" * 3000 + "deep" + "<div>" * 3000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = extract_main_text(df).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[2] == text[3] == text[None] == "" and text[4] == "plain text only" and text[6] == "deep"
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert extract_main_text(df.limit(0)).count() == 0
