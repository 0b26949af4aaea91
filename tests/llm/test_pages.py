"""URL reputation, capture index, main-text extraction and chat masks."""

import base64
import hashlib
import html
import random
import re

import numpy as np
import pytest

from landledger.llm import block_labeller, capture_index, chat_masks, url_reputation
from landledger.session import scratch_path

# --- URL reputation ----------------------------------------------------------


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        ("http://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/"),
        ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1"),
        ("http://badexample.org/es/1", "badexample.org", "/es/1", "org/"),
        ("http://x.org", "x.org", "", None),
        ("ftp://b.com/de/://c.org/", "b.com", "/de/://c.org/", "com/de/"),
        ("http://b.com?/de/", "b.com", "", None),
        ("http://b.com#/fr/", "b.com", "", None),
        ("HTTP://É.com/fr/\nx", "É.com", "/fr/\nx", "com/fr/"),
        ("no scheme/fr/", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
    ],
)
def test_url_parts_and_rules(spark, url, host, path, rule):
    pages = spark.createDataFrame([(1, url, "n", 2.0)], "page_id long, url string, verdict string, mean double")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    row = url_reputation.filter_urls(pages, labels).first()
    assert (row.host, row.path, row.rule, row["mean"]) == (host, path, rule, 2.0)
    assert row.verdict == {"org/": "allow", "com/fr/": "allow"}.get(rule, "block")


def shrink(groups, parent):
    """Posterior (alpha, beta) of each group, as the module's docstring has it."""
    seen = sum((y - n * parent[g]) ** 2 for g, (y, n) in groups.items())
    spread = {g: parent[g] * (1 - parent[g]) * n for g, (y, n) in groups.items()}
    pairs = sum(spread[g] * (n - 1) for g, (y, n) in groups.items())
    overlap = (seen - sum(spread.values())) / pairs if pairs else 0
    m = 1e6 if overlap <= 1 / (1e6 + 1) else max(1 / overlap - 1, 0.5)
    return {g: (y + m * parent[g], n - y + m * (1 - parent[g])) for g, (y, n) in groups.items()}


def test_reputation_shrinks_level_by_level(spark):
    rng = random.Random(1)
    pages, labels, outcome = [], [], {}
    for h in range(30):
        host = f"h{h}.d{h % 7}.{'net' if h % 2 else 'io'}"
        share = 0.1 if h % 7 == 3 else 0.95
        for _ in range(rng.randrange(1, 30)):
            k = len(pages)
            pages.append((k, f"http://{host}/p/{k}"))
            if rng.random() < 0.6:
                labels.append((k, int(rng.random() < share)))
    quality = dict(labels)
    for k, url in pages:
        host = url.split("/")[2]
        y, n = outcome.get(host, (0, 0))
        outcome[host] = (y + quality.get(k, 0), n + (k in quality))
    pages += [(-1, "http://new.d3.net/x"), (-2, "http://new.d1.net/x"), (-3, None)]
    for _, url in pages[-3:]:
        outcome.setdefault(url.split("/")[2] if url else "", (0, 0))
    domain = {h: ".".join(h.split(".")[-2:]) for h in outcome}
    suffix = {d: d.split(".")[-1] for d in domain.values()}

    def summed(keys):
        out = {}
        for h, (y, n) in outcome.items():
            a, b = out.get(keys(h), (0, 0))
            out[keys(h)] = (a + y, b + n)
        return out

    tops, domains = summed(lambda h: suffix[domain[h]]), summed(lambda h: domain[h])
    y, n = (sum(v[i] for v in outcome.values()) for i in (0, 1))
    mean = lambda ab: {g: a / (a + b) for g, (a, b) in ab.items()}
    top_mean = mean(shrink(tops, dict.fromkeys(tops, (y + 1) / (n + 2))))
    domain_mean = mean(shrink(domains, {d: top_mean[suffix[d]] for d in domains}))
    hosts = shrink(outcome, {h: domain_mean[domain[h]] for h in outcome})
    df = spark.createDataFrame(pages, "page_id long, url string")
    got = url_reputation.filter_urls(df, spark.createDataFrame(labels, "doc_id long, quality int"), rules=()).collect()
    assert len(got) == len(pages)
    for r in got:
        a, b = hosts[r.host]
        bound = a / (a + b) - 1.645 * (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5
        assert r.lower_bound == pytest.approx(bound)
        assert r.verdict == ("allow" if bound >= 0.5 else "block")
    assert {r.verdict for r in got} == {"allow", "block"}


def test_urls_repeats_suffixes_and_nothing(spark):
    schema = "page_id long, url string, host int"
    pages = spark.createDataFrame([(1, "http://a.b.co.uk/7", 1), (1, "http://a.b.co.uk/7", 1), (None, "http://co.uk/8", 1)], schema)
    labels = spark.createDataFrame([(7, 1), (7, 1), (7, 0), (8, None), (None, 1)], "doc_id long, quality int")
    got = url_reputation.filter_urls(pages, labels, suffixes=("co.uk",)).collect()
    assert sorted((str(r.page_id), r.host) for r in got) == [("1", "a.b.co.uk"), ("1", "a.b.co.uk"), ("None", "co.uk")]
    assert url_reputation.filter_urls(pages.filter("false"), labels).collect() == []
    assert url_reputation.filter_urls(pages, labels.filter("false")).count() == 3


# --- Capture index -----------------------------------------------------------


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_archives_round_trip(spark, monkeypatch):
    long = "<p>" + "long é " * 100_000
    rows = [(3, "http://b.com/x", "same", 1), (2, "http://a.b.com/y#f", "same", 1), (5, None, None, 1), (4, "no\r\nscheme: ", "", 1),
            (7, "http://b.com/x", long, 1), (8, "http://b.com/x?q", "é\r\n\r\nWARC/1.1", 1), (None, "http://c.org", "same", 1), (None, "http://c.org", "lone", 1), (2, "http://a.b.com/y#f", "same", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha int")
    folder = scratch_path(spark, "captures")
    index = capture_index.build_index(capture_index.write_archives(pages, folder), folder, block_lines=2)
    got = capture_index.read_all(index).collect()
    first = {"same": 2, "": 4}
    expected = []
    for page_id, url, text, _ in rows:
        text = text or ""
        refers = first.get(text)
        kind = "response" if refers is None or refers == page_id else "revisit"
        expected.append((page_id, url, len(text.encode()), digest(text), kind, refers if kind == "revisit" else None))
    key = lambda t: tuple(map(str, t))
    fields = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=key) == sorted(expected, key=key)
    assert all(bytes(r.payload).decode() == (next(t for i, u, t, _ in rows if (i, u) == (r.page_id, r.url)) or "") for r in got if r.record_type == "response" and r.page_id)
    # by URL: every key, one that is absent, and one that several pages and blocks share
    urls = spark.createDataFrame([("http://b.com/x#other",), ("http://a.b.com/y",), (None,), ("http://zzz.com/",), ("http://B.com/x",)], "url string")
    found = [str(r.page_id) for r in capture_index.look_up(index, urls).collect()]
    assert sorted(found) == ["2", "2", "3", "3", "5", "7", "7"]
    once = [str(r.page_id) for r in capture_index.look_up_keys(index, urls).collect()]
    assert sorted(once) == ["2", "2", "3", "5", "7"]
    # every key of the pages finds every record once
    every = capture_index.look_up_keys(index, pages.unionByName(pages)).collect()
    assert sorted((tuple(r[f] for f in fields) for r in every), key=key) == sorted(expected, key=key)


def test_archives_share_only_from_a_size_on(spark):
    pages = spark.createDataFrame([(i, f"http://a.com/{i}", t) for i, t in enumerate(["ab", "ab", "abcd", "abcd"])], "page_id long, url string, html string")
    got = capture_index.read_all(capture_index.archive(spark, pages, least_bytes=3)).collect()
    assert {r.page_id: (r.record_type, r.refers_to) for r in got} == {0: ("response", None), 1: ("response", None), 2: ("response", None), 3: ("revisit", 2)}
    assert capture_index.read_all(capture_index.archive(spark, pages.filter("false"))).collect() == []


def test_url_keys():
    assert capture_index.url_key("http://Blog.Example.com/a?b#c") == "com,example,blog)/a?b"
    assert capture_index.url_key(None) == "" and capture_index.url_key("plain") == "plain"


# --- Main text ---------------------------------------------------------------


def test_leaf_blocks_forgive():
    page = (
        "<!doctype html><head><title>no</title></head><body class='x'><script>var a='<p>no</p>';</script><p>one <b>bo</b>ld<br>two"
        "<p>three &amp; &lt;four&gt; &#233;&nbsp;&nbsp;five</p></i><ul><li>a<li>b</ul><!-- <p>no</p> --><style>p{}</style>"
        "<img alt='>'>tail <a href=\"x>y\">link</a> &amp"
    )
    assert [t for _, t in block_labeller.leaf_blocks(page)] == ["one bold", "two", "three & <four> é five", "a", "b", "tail link &"]
    paths = dict((t, p) for p, t in block_labeller.leaf_blocks(page))
    assert paths["b"][-2:] == ("ul", "li") and paths["a"][-2:] == ("ul", "li") and paths["three & <four> é five"][-1] == "p"
    for text in (None, "", " ", "<", "<p", "<!--", "a < b"):
        block_labeller.leaf_blocks(text)
    assert block_labeller.leaf_blocks("a < b")[0][1] == "a < b"
    assert block_labeller.leaf_blocks("<p>x</p>" * 20_000)[-1][1] == "x"


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<html><head><title>no</title><meta charset=x><body><article><p>one</p></article>", ["one"]),
        ("<head><title>no</title><article><p>one<p>two</article>", ["one", "two"]),
        ("<head><link href=x>one<p>two", ["one", "two"]),
        ("<head><template><div>no</div></template><script>no</script></head><p>one", ["one"]),
        ("<body><svg><text>no<p>one</p>", ["one"]),
        ("<svg><foreignObject><div>no</div></foreignObject></svg><p>one", ["one"]),
        ("<select><option>no<article>one", ["one"]),
        ("<div><object>no<p>no</div><p>one", ["one"]),
    ],
)
def test_leaf_blocks_end_unclosed_hidden_elements(page, texts):
    blocks = block_labeller.leaf_blocks(page)
    assert [t for _, t in blocks] == texts
    assert not any("head" in path for path, _ in blocks)


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = block_labeller.new_network()
    net.inputs, net.states, net.biases = ([w.astype(float) for w in ws] for ws in (net.inputs, net.states, net.biases))
    net.out, net.bias = net.out.astype(float), net.bias.astype(float)
    x = rng.random((2, 4, block_labeller.WIDTH))
    live = np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool)
    y = rng.integers(0, 2, (2, 4)).astype(float)

    def loss():
        p = block_labeller.label_probabilities(x, live, net)
        return -(np.where(y == 1, np.log(p), np.log(1 - p)) * live).sum() / live.sum()

    for w, g in zip(net.parameters(), block_labeller._gradients(x, live, y, net)):
        at = tuple(rng.integers(0, s) for s in w.shape)
        kept, step = w[at], 1e-3
        w[at] = kept + step
        up = loss()
        w[at] = kept - step
        down = loss()
        w[at] = kept
        assert g[at] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-4)


def test_articles_are_extracted_whole(spark):
    folder = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    got = block_labeller.op10_block_labeller(spark, folder).collect()
    wanted = {}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inside))
        wanted[r.page_id] = " ".join(x for x in parts if x)
    assert len(got) == len(wanted)
    assert np.mean([r.text == wanted[r.page_id] and r.n_chars == len(r.text) for r in got]) >= 0.99


def test_other_markup_is_labelled_by_context(spark):
    pages = [block_labeller.leaf_blocks(r.html) for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(300).collect()]
    net = block_labeller.train(pages)
    page = (
        '<body><header><h1>Site name</h1></header><div class="menu"><a href="/">Home</a></div><div class="cookie-notice">We use cookies</div>'
        '<div class="content"><h1>A longer title of this text</h1><p>First paragraph of the text, which is long enough to read.</p>'
        '<p>Second paragraph of the text, as long as the first one or so.</p></div>'
        '<div class="comments"><div class="comment"><p>I like it a lot, really good work.</p></div></div>'
        '<form><label>Name</label></form><div class="sidebar"><ul><li><a>One</a></li></ul></div><footer>foot</footer></body>'
    )
    text = block_labeller.extract([page], net, {})[0]
    assert "First paragraph" in text and "Second paragraph" in text
    assert not any(w in text for w in ("Site", "Home", "cookies", "I like", "Name", "One", "foot"))


def test_main_text_of_odd_rows(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    rows = [(1, "u", None, 1, "x"), (1, "u", None, 1, "x"), (None, None, "", 1, "x"), (3, "u", "<article>" + "<p>a b</p>" * 20_000, 1, "x")]
    pages = spark.createDataFrame(rows, schema)
    got = block_labeller.with_main_text(pages, block_labeller.fit(pages)).collect()
    assert [(r.page_id, r.n_chars == len(r.text)) for r in got] == [(1, True), (1, True), (None, True), (3, True)]
    assert got[0].text == "" and got[2].text == ""
    nothing = pages.filter("false")
    assert block_labeller.with_main_text(nothing, block_labeller.fit(nothing)).collect() == []


# --- Chat masks --------------------------------------------------------------


def test_chats_round_trip(spark):
    tricky = ["<|im_end|><|im_start|>assistant ok", "\\", "<\\|", "<", "|>", "\n\n", " lead", "trail ", "", None, "é😀 ﬁ", "<|endoftext|>", "a\\<|b", "long words " * 20_000, "a" + " " * 1_500_000 + "b"]
    rng = random.Random(4)
    rows = []
    for c in range(12):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", "system", None, "we<|ird\n\\"]), rng.choice(tricky), 1))
    rows += [(None, 1, "user", "x", 1), (None, 1, "assistant", "y", 1), (None, 2, "assistant", "y", 1), (77, None, "assistant", "first", 1), (77, 0, "assistant", "b", 1), (77, 0, "assistant", "a", 1), (77, 0, "assistant", "a", 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    formatted = chat_masks.format_chats(turns)
    order = lambda v: (v is not None, v if v is not None else 0)
    wanted = {}
    for c, t, role, text, _ in sorted(rows, key=lambda r: (order(r[0]), order(r[1]), (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or ""))):
        wanted.setdefault(c, []).append((role or "", text or ""))
    # rows without a conversation are conversations of their own
    alone = wanted.pop(None)
    assert sorted(chat_masks.parse(r.formatted)[0] for r in formatted.filter("conv_id IS NULL").collect()) == sorted(alone)
    formatted = formatted.filter("conv_id IS NOT NULL")
    for r in formatted.collect():
        assert chat_masks.parse(r.formatted) == wanted[r.conv_id]
        learned = [t for role, t in wanted[r.conv_id] if role == "assistant" and t]
        assert chat_masks.masked_texts(r.formatted, r.token_starts, r.token_ends, r.loss_mask) == learned
    got = {r.conv_id: r for r in chat_masks.digests(formatted).collect()}
    assert set(got) == set(wanted)
    for c, turns_ in wanted.items():
        told = "".join(f"{role}\n{text}\n" for role, text in turns_).encode()
        learned = "".join(text for role, text in turns_ if role == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns_), hashlib.sha256(told).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert chat_masks.digests(chat_masks.format_chats(turns.filter("false"))).collect() == []


def test_chat_encoders_agree():
    with open(chat_masks.TOKENIZER, "rb") as f:
        fast = chat_masks.Encoder(f.read())
    assert fast.ranked is not None
    texts = ["", None, "é 日本語🙂🙂   don't  \n\n x", "<|im_end|>\\<|endoftext|> 1234  ", "\u00a0\u2003 é" * 50, "a" * 5000]
    for text in [chat_masks.render([("assistant", t), ("user", t)])[0] for t in texts] + [""]:
        got = fast.encode(text)
        code = fast.whole.encode(text, add_special_tokens=False)
        assert (got[0].tolist(), list(zip(got[1].tolist(), got[2].tolist()))) == (code.ids, [tuple(o) for o in code.offsets])


def test_records_of_many_keys_are_handed_over_together(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://a.org/{i}", "x" * i) for i in range(50)], "page_id long, url string, html string")
    index = capture_index.archive(spark, pages)
    found = capture_index.visits(index, pages).sort("blocks", "offset", "key").toPandas()

    class Wanted:
        def repartition(self, *args):
            return self

        sortWithinPartitions = repartition

        def mapInPandas(self, records, schema):
            return list(records(iter([found])))

    monkeypatch.setattr(capture_index, "visits", lambda *args: Wanted())
    frames = capture_index.look_up_keys(index, pages)
    assert [sorted(f["page_id"]) for f in frames] == [list(range(50))]
