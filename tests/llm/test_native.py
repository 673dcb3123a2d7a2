import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from appendlake.llm import cws, hosts, pii


def jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_edited_texts(odd_docs, no_docs):
    rows = cws.edited(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert cws.edited(no_docs).count() == 0
    source = {(r.doc_id, r.text or "") for r in odd_docs.collect()}
    order = sorted(source, key=lambda r: (r[0] is not None, r[0] or 0))
    by_id = {r.doc_id: r for r in rows}
    for i, (doc_id, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = by_id[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        blank = lambda t: not re.sub("[\x20\x09-\x0d]", "", t)
        assert r.near_next == (1.0 if text == after or blank(text) and blank(after) else r.near_next)
        if blank(text):
            assert r.fingerprint == ""
    assert by_id[0].fingerprint == by_id[1].fingerprint and len(by_id[0].fingerprint) == 4 * cws.SAMPLES


def test_one_document(docs_of):
    (r,) = cws.edited(docs_of(["some words here"])).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"some words hsom").hexdigest()


def test_a_word_of_equal_weight_in_both_texts_is_sampled_once(spark):
    texts = spark.createDataFrame([(0, "a b b c", "b a b d a"), (1, "x y", "x y"), (2, "", None)], "id long, x string, y string")
    rows = texts.select("id", cws._terms(F.col("x")).alias("hs0"), cws._terms(F.col("y")).alias("hs1"))
    rows = rows.select("id", "hs0", "hs1", *[cws._firsts(F.col(f"hs{i}")).alias(f"first{i}") for i in range(2)])
    rows = rows.select("id", F.sort_array(F.concat(cws._runs("hs0", "first0", 0), cws._runs("hs1", "first1", 1))).alias("runs"))
    got = {r.id: sorted((x.n, x.texts) for x in r.merged) for r in rows.select("id", cws._merged("runs", 2).alias("merged")).collect()}
    assert got == {0: [(1, 1), (1, 1), (1, 2), (2, 2), (2, 3)], 1: [(1, 3), (1, 3)], 2: []}


def test_dropped_samples_never_change_a_signature(spark):
    """Whether few, some or no samples are dropped; rows left without a sure winner are sampled again."""
    rows = [(i, " ".join(f"w{j % (7 + i)}" for j in range(i * i)), " ".join(f"v{j * j % 50}" for j in range(30 * i)) or None) for i in range(25)]
    texts = spark.createDataFrame(rows, "id long, x string, y string")
    found = [sorted(cws.signatures(texts, ["id"], ["x", "y"], keep=k).collect()) for k in (float("inf"), cws.KEEP, 4.0, 0.05)]
    assert all(f == found[0] for f in found)
    assert [(r.id, r.x_sig is None, r.y_sig is None) for r in found[0]] == [(i, i == 0, i == 0) for i in range(25)]
    assert all(len(r.x_sig) == len(r.y_sig) == cws.SAMPLES for r in found[0][1:])
    unsure = [cws._sampled(texts, ["id"], ["x", "y"], (), k).filter("not sure").count() for k in (float("inf"), 0.05)]
    assert unsure[0] == 0 and unsure[1] > 0


def test_most_samples_take_no_logarithm(spark):
    """Of 500 words of weight 1 or 3, few may win; those that may include each with a below the limit."""
    rows = spark.range(500).select(F.when(F.col("id") % 2 == 0, 1).otherwise(3).alias("n"), F.xxhash64("id").alias("term"))
    rows = rows.select("n", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("k"), "term").select("n", F.xxhash64("term", "k").alias("h"))
    limit = cws.KEEP / 1000
    may = cws._may_win(F.col("h"), F.col("n"), F.lit(limit)).alias("may")
    got = rows.select(may, cws._log_a(cws._sample(F.col("h"), F.log(F.col("n").cast("double")))).alias("log_a"))
    r = got.agg(F.avg(F.col("may").cast("int")).alias("share"), F.min(F.when(~F.col("may"), F.exp("log_a"))).alias("least_dropped")).first()
    assert r.share < 0.25 and r.least_dropped > limit


def test_collisions_follow_the_weighted_similarity(docs_of):
    texts = []
    for i in range(60):
        own = [f"t{j}" for j in range(30)] + ["much"] * (i % 9 * 4) + [f"own{i}x{j}" for j in range(i % 20)]
        texts.append(" ".join(own))
    rows = sorted(cws.edited(docs_of(texts)).collect(), key=lambda r: r.doc_id)
    errors = [r.near_next - jaccard(texts[i], texts[(i + 1) % 60]) for i, r in enumerate(rows)]
    assert abs(sum(errors) / 60) < 0.03
    assert max(map(abs, errors)) < 0.25


def test_long_texts_with_unequal_weights_are_not_biased(spark):
    """Half of the words weigh 4 in one text and 1 in the other: similarity 1/4, however many words there are."""
    word = lambda i: F.concat(F.lit("w"), F.col("id").cast("string"), F.lit("x"), i.cast("string"))

    def text(heavy, light):
        parts = [F.transform(F.sequence(F.lit(a), F.lit(a + 9_999)), word) for a in (heavy, light)]
        return F.array_join(F.concat(*[parts[0]] * 4, parts[1]), " ")

    texts = spark.range(100).repartition(8).select("id", text(0, 10_000).alias("x"), text(10_000, 0).alias("y"))
    likeness = cws.likeness(F.col("x_sig"), F.col("y_sig"))
    assert abs(cws.signatures(texts, ["id"], ["x", "y"]).agg(F.avg(likeness)).first()[0] - 0.25) < 0.01


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[ \-]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9\-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in found.split(".")), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


PRIVATE = [
    "a@b.c%d@e.f and x@y and @z.com mail a.b+c@d-e.co.uk.x, 😀 é z@q.org",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 0001.002.3.255 9.9.9.9999 12.34.56.78",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111 4111111111111111 3 5 1",
    "4111\x01111111111111 4111 -1111 41111111111111111111",
    "+1 (017) 555-7713 +12 +123456789012345678 ++49 30 1234567 +1+2+3 +49-30.123(4)5678 ",
    "call me: (415) 555-2671 or 415-555-2671 today, bob [at] mail [dot] com",
    "1 " * 20_000, "9.9.9.9 " * 300, "a" * 30_000 + "@", "a@" * 5000, None, "",
]


def test_base_spans(docs_of, odd_docs, no_docs):
    for docs in (docs_of(PRIVATE), odd_docs):
        rows, learned = pii.found(docs)
        assert all(0 <= v <= 1 for v in learned.reliability.values())
        texts = {r.doc_id: r.text or "" for r in docs.collect()}
        got = rows.collect()
        assert len(got) == docs.count()
        for r in got:
            text = texts[r.doc_id]
            expected = [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text) if passes(k, m[0])]
            assert [(s.kind, s.start, s.end) for s in r.spans if s.base] == expected
    rows, _ = pii.found(no_docs)
    assert rows.count() == 0


def test_masked(docs_of, no_docs):
    docs = docs_of(["é write to a@b.com, 10.0.0.1 or +1 (017) 555-7713!", None, "", "clean 12 3.4"])
    rows = {r.doc_id: r for r in pii.masked(docs).collect()}
    assert [rows[i].text for i in range(4)] == ["é write to <EMAIL>, <IP> or <PHONE>!", None, "", "clean 12 3.4"]
    assert rows[0]["a.b"] == "y" and pii.masked(docs).columns == docs.columns
    assert pii.masked(no_docs).count() == 0


def test_voters_decide_on_loose_forms(docs_of):
    texts = [f"phone: +1 (415) 555-{i:04d} now" for i in range(60)] + ["tel: (415) 555-2671 please", "4111 1111 1111 1112 no card"]
    rows, _ = pii.found(docs_of(texts))
    extra = {r.doc_id: [s.kind for s in r.spans if not s.base] for r in rows.collect()}
    assert extra[60] == ["phone"] and extra[61] == []


@pytest.fixture(scope="module")
def pages(spark):
    link = lambda *hs: "".join(f'<a href="https://{h}/x?y">t</a>' for h in hs)
    rows = [
        (1, "https://Good.Example.org/fr/a?q#f", link("friend.test", "friend.test")),
        (2, "http://good.example.org/fr/", None),
        (3, "http://bad.NET/", link("x.test")),
        (4, "http://pointer.test/a", link("bad.net", "bad.net:80")),
        (5, "http://friend.test/b", "<p>nothing</p>"),
        (6, "http://www.friend.test/c", ""),
        (7, "http://a.example.net/en/x", ""), (8, "http://a.example.net/EN/x", ""), (9, "http://net", ""),
        (10, None, link("bad.net")), (11, "no scheme", ""), (12, "x://h\ny/de/?", ""), (13, "http://example.com/de/", ""),
        (13, "http://example.com/de/", ""), (None, "http://xnet/", ""), (14, "http://éÉ.org#/fr/", ""),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))


def test_verdicts(spark, pages):
    rows = hosts.judged(pages).collect()
    assert len(rows) == pages.count()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert got[1] == ("good.example.org", "/fr/a", "org/fr/", "allow")
    assert got[3] == ("bad.net", "/", "net/", "block")
    assert got[4] == ("pointer.test", "/a", None, "block")  # it links to a blocked host
    assert got[5][3] == got[6][3] == "allow"
    assert got[7][2:] == ("example.net/en/", "allow") and got[8][2:] == ("net/", "block")
    assert got[9] == ("net", "", None, "block")  # its subdomain is blocked
    assert got[10] == got[11] == ("", "", None, "allow")
    assert got[12] == ("h\ny", "/de/", None, "allow")
    assert got[13][2:] == ("example.com/de/", "block") and got[None][2] is None
    assert got[14][0] == "éÉ.org"
    trust = {r.host: (r.trust, r.distrust) for r in rows}
    assert trust["friend.test"][0] > trust["friend.test"][1] == 0
    assert hosts.judged(pages.limit(0)).count() == 0


def test_hosts_with_few_ruled_pages_are_seeds(spark):
    """One page in five has a rule: it still decides for the others of its host."""
    rows = [(10 * h + i, f"http://{host}/{'xx' if i else ruled}/{i}") for h, (host, ruled) in enumerate((("example.com", "de"), ("a.org", "fr"))) for i in range(5)]
    rows += [(20, "http://example.net/en/"), (21, "http://example.net/"), (22, "http://example.net/"), (23, "http://example.net")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("html", F.lit(""))
    got = {r.page_id: r for r in hosts.judged(pages).collect()}
    assert {got[i].verdict for i in range(5)} == {"block"} and got[1].distrust > got[1].trust == 0
    assert {got[i].verdict for i in range(10, 15)} == {"allow"} and got[11].trust > got[11].distrust == 0
    assert got[23].trust > 0 and got[23].distrust > 0  # both kinds of pages, both kinds of seed


def test_siblings_pass_trust_without_a_page_of_their_parent(spark):
    rows = [
        (1, "http://a.x.example.com/de/"), (2, "http://b.x.example.com/"), (3, "http://c.example.com/"),
        (4, "http://a.one.co.uk/"), (5, "http://b.two.co.uk/"), (6, "http://10.0.0.1/"), (7, "http://11.0.0.1/"), (8, "http://other.com/"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("html", F.lit(""))
    got = {r.page_id: (r.verdict, r.distrust > 0) for r in hosts.judged(pages).collect()}
    assert got == {i: ("block", True) if i <= 3 else ("allow", False) for i in range(1, 9)}
    names = spark.createDataFrame([("a.one.co.uk",), ("b.two.co.uk",), ("10.0.0.1",), ("11.0.0.1",), ("d.e.test",)], "host string")
    got = {(r.a, r.b) for r in hosts.kinship(names).collect()}
    assert got == {("a.one.co.uk", "one.co.uk"), ("b.two.co.uk", "two.co.uk"), ("d.e.test", "e.test")}


def test_walk_is_personalised_pagerank(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "c")]
    seeds = spark.createDataFrame([("trust", "a", 1.0), ("distrust", "c", 1.0)], "kind string, host string, weight double")
    walk = hosts.Walk(damping=0.4, tolerance=1e-5)
    rows = hosts.propagated(spark.createDataFrame(edges, "a string, b string"), seeds, walk).collect()
    for column, links, seed in (("trust", edges, "a"), ("distrust", [(b, a) for a, b in edges], "c")):
        score = dict.fromkeys("abcd", 0.0)
        for _ in range(200):
            new = {h: 0.6 * (h == seed) for h in score}
            for a, b in links:
                new[b] += 0.4 * score[a] / sum(x == a for x, _ in links)
            score = new
        assert {r.host: pytest.approx(r[column], abs=1e-4) for r in rows} == {r.host: score[r.host] for r in rows}


def test_walk_goes_on_while_it_reaches_hosts(spark):
    """A chain longer than ``most_steps``; and many hosts, each with a tiny score."""
    chain = spark.createDataFrame([(f"h{i}", f"h{i + 1}") for i in range(8)], "a string, b string")
    seeds = spark.createDataFrame([("trust", "h0", 1.0)], "kind string, host string, weight double")
    got = {r.host: r.trust for r in hosts.propagated(chain, seeds, hosts.Walk(most_steps=3, tolerance=0.9)).collect()}
    assert got == {f"h{i}": pytest.approx(0.15 * 0.85**i) for i in range(9)}
    tiny = seeds.withColumn("weight", F.lit(1e-9))
    ring = spark.createDataFrame([("h0", "h1"), ("h1", "h0")], "a string, b string")
    got = {r.host: r.trust for r in hosts.propagated(ring, tiny, hosts.Walk(tolerance=1e-3)).collect()}
    assert got["h0"] == pytest.approx(1e-9 * 0.15 / (1 - 0.85**2), rel=1e-2)
