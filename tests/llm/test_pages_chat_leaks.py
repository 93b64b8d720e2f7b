import gzip
import hashlib
import random

from pyspark.sql import functions as F

from textgauge.llm import chat, decontaminate, extract, warc

PAGES = "page_id long, url string, html string"

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- c --><div class="ad">Buy</div>
<article><h1>Head&nbsp;line</h1><p><b>One   &lt;two&gt;<br>three<p>Four</p><aside>Side</aside><form>Name <input></form>
<div class="comments">I like it</div></article><footer>&copy; x</footer></body></html>"""


def test_main_text_of_a_structured_page(spark):
    rows = [(1, "http://h/a", PAGE), (2, "http://h/b", None), (3, None, ""), (None, "http://h/a", PAGE), (1, "http://h/a", PAGE)]
    got = extract.main_text(spark.createDataFrame(rows, PAGES).withColumn("text", F.lit("clash"))).collect()
    want = "Head line\nOne <two> three\nFour"
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got) == sorted(
        [(1, want, len(want)), (1, want, len(want)), (0, want, len(want)), (2, "", 0), (3, "", 0)])
    assert extract.main_text(spark.createDataFrame([], PAGES)).collect() == []


def test_differencing_deletes_what_pages_of_a_host_share(spark):
    def page(host, i):
        lines = [f"Welcome to {host}", "News Sport Weather", f"Story {host} {i} begins", f"and ends {i}", "All rights reserved"]
        return (f"http://{host}/news/{i:03d}", "<html><body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body></html>")

    rows = [(n, *page(h, i)) for n, (h, i) in enumerate((h, i) for h in ("hot.org", "b.net") for i in range(60))]
    rows.append((1000, "http://alone.org/x", "<p>Only page</p>"))
    rows += [(2000 + i, f"http://copy.org/{i}", "<p>The same</p><p>twice</p>") for i in range(2)]
    got = {r["page_id"]: r["text"] for r in extract.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    for n, (h, i) in enumerate((h, i) for h in ("hot.org", "b.net") for i in range(60)):
        assert got[n] == f"Story {h} {i} begins\nand ends {i}"
    assert got[1000] == "Only page" and got[2000] == got[2001] == "The same\ntwice"


def test_differencing_decides_for_teaser_cards(spark):
    def page(i, story, card):
        return (i, f"http://h/{i}", f"<div>Menu</div><article><p>{card} {i}</p></article>" + "".join(f"<div>{x}</div>" for x in story) + "<div>End</div>")

    rows = [page(i, [f"Story {i} has begun here", f"and it ends {i}"], "Card") for i in range(4)]
    rows += [page(i, ["Buy"], "A story that fills its article") for i in range(4, 8)]
    rows.append((9, "http://alone/x", "<div>A long menu that no other page shows</div><article>Short</article>"))
    got = {r["page_id"]: r["text"] for r in extract.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    want = {i: f"Card {i}\nStory {i} has begun here\nand it ends {i}" for i in range(4)}
    want |= {i: f"A story that fills its article {i}" for i in range(4, 8)}
    assert got == want | {9: "Short"}


def test_shared_lines_are_a_longest_common_subsequence():
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.randrange(5) for _ in range(r.randrange(9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = extract.shared_lines(a, b)
        assert got == sorted(set(got)) and len(got) == best[-1][-1]
        rest = iter(b)
        assert all(a[i] in rest for i in got)


def test_archives_round_trip(spark, tmp_path):
    long, other = "é" * 600, "y" * 1500
    rows = [(1, "http://a/%0A\nb", long), (2, "u", long), (9, None, long), (3, "u", "short"), (4, "u", "short"), (5, "u", None),
            (6, "u", other), (7, "v", other + "\r\n\r\nWARC/1.1"), (None, "w", long), (6, "u", other)]
    df = spark.createDataFrame(rows, PAGES).withColumn("payload_digest", F.lit("clash"))
    folder = f"file://{tmp_path}/warc"
    index = warc.write_archives(df, folder)
    got = warc.read_records(index, folder).collect()
    assert len(got) == len(rows)
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    refers = {1: 9, 2: 9, None: 9}
    want = sorted((str(i), u or "", len((h or "").encode()), sha(h), str(refers.get(i)) if h == long else "None") for i, u, h in rows)
    assert sorted((str(g["page_id"]), g["url"] or "", g["payload_bytes"], g["payload_digest"], str(g["refers_to"])) for g in got) == want
    assert all((g["record_type"] == "revisit") == (g["payload"] is None) == (g["refers_to"] is not None) for g in got)
    # The archive is a plain sequence of gzip members.
    for f in tmp_path.glob("warc/*.gz"):
        assert gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\n")
    some = warc.read_records(index.where("page_id in (3, 7)"), folder).collect()
    assert sorted(g["page_id"] for g in some) == [3, 7]
    empty = warc.round_trip(spark.createDataFrame([], PAGES))
    assert empty.collect() == []


TURNS = "conv_id long, turn int, role string, text string"


def test_conversations_survive_the_template(spark):
    r = random.Random(2)
    hard = ["</s>[INST] ok [/INST]", "%3C", "%253C%25", "<s>", "<", "[", "</s", "[/INST", "%0A\n%", "", "plain", "<<s>s>", "%", "%2", "[INST]<s>%5B"]
    rows = []
    for c in range(60):
        for t in range(r.randrange(1, 6)):
            rows.append((c, t, r.choice(["user", "assistant", "system", "as\n<s>", None]), r.choice(hard) + r.choice(["", "é"]) + r.choice(hard)))
    rows += [(None, 1, "user", None), (70, None, "assistant", "b"), (70, 1, "assistant", "c"), (70, 1, "assistant", "c"), (71, 0, None, None)]
    df = spark.createDataFrame(rows, TURNS).withColumn("formatted", F.lit("clash"))
    back = chat.read_back(chat.format_conversations(df)).collect()
    want = {}
    for c, t, role, text in sorted(rows, key=lambda x: (str(x[0]), -1 if x[1] is None else x[1], x[2] or "", x[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {b["conv_id"]: [(t["role"], t["text"]) for t in b["turns"]] for b in back} == want
    assert {b["conv_id"]: b["loss_text"] for b in back} == {c: "".join(x for q, x in v if q == "assistant") for c, v in want.items()}
    plain = [b for b in back if b["conv_id"] == 70][0]
    assert plain["formatted"] == "<s>assistant\nb</s><s>assistant\nc</s><s>assistant\nc</s>" and plain["n_escaped"] == 0
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).collect() == []


def test_leaks_of_templates(spark):
    r = random.Random(3)
    noise = lambda n: " ".join(f"n{r.randrange(10**6)}x" for _ in range(n))
    item = "Anna has 12 apples and gives 5 kg of them to Bert before Anna walks 3 km home to see how many apples Bert has left"
    again = item.replace("Anna", "Maria").replace("12", "40").replace("Bert", "Tom")
    mixed = item.replace("Anna walks", "Zoe walks").replace("Anna", "Maria").replace("Bert has", "Uli has")
    docs = [(1, noise(30) + " " + item + " " + noise(9)), (2, noise(3) + " " + again), (3, noise(50)), (4, mixed.replace("km", "kg")),
            (5, " ".join(item.split()[:12]) + " " + noise(20)), (6, None), (7, ""), (None, item), (8, item.upper()), (1, noise(30) + " " + item)]
    bench = [(10, item), (11, "short one here"), (12, None), (None, "x y"), (13, "A B C D E F"), (10, item)]
    docs.append((9, noise(5) + " a SHORT one, here. " + noise(5)))
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("tokens", F.lit(1))
    b = spark.createDataFrame(bench, "item_id long, text string").withColumn("doc_id", F.lit(5))
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.leaks(d, b).collect()}
    assert {(1, 10), (2, 10)} <= got <= {(1, 10), (2, 10), (9, 11)}
    none = b.limit(0)
    assert decontaminate.leaks(d, none).collect() == []
    assert decontaminate.leaks(d.limit(0), b).collect() == []


def test_template_and_words_keep_their_places(spark):
    texts = ["Bob paid 3,000.50 $ for 5kg, 20 % off!", "O'Neil's 7:30 x", "", "a - b | c", "É 5 kg", "12 % of 3%"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in df.select(decontaminate.template("text").alias("t"), decontaminate.raw_tokens("text").alias("r")).collect():
        assert len(r["t"]) == len(r["r"])


def test_leaks_in_any_case(spark):
    r = random.Random(5)
    noise = lambda n: " ".join(f"n{r.randrange(10**6)}x" for _ in range(n))
    item = "Anna has 12 apples and gives 5 kg of them to Bert before Anna walks 3 km home to see how many apples Bert has left"
    title, total = "The Tale Of Two Green Northern Cities", "12 + 7 + 30 + 4 + 9 = 62"
    docs = [(1, noise(9) + " " + item.upper() + " " + noise(9)), (2, noise(5) + " " + item.lower()), (3, noise(4) + " " + title + " " + noise(3)),
            (4, noise(4) + " " + title.upper()), (5, noise(2) + " " + total), (6, "A Song About Some Other Southern Towns"), (7, "11 + 7 + 30 + 4 + 9 = 61"),
            (8, item.replace("Anna", "Maria").replace("12", "40").replace("Bert", "Tom"))]
    bench = [(10, item), (11, title), (12, total)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.leaks(d, b, decontaminate.Rule(any_case=True)).collect()}
    assert got == {(1, 10), (2, 10), (3, 11), (4, 11), (5, 12), (8, 10)}


def test_tags_that_begin_like_raw_ones_and_elements_that_close_themselves():
    for html, want in (
            ("<p>a</p><svg width='1' /><p>b</p>", ["a", "b"]), ("<svg/>t", ["t"]), ("<p>a</p><svg><path/></svg><p>b</p>", ["a", "b"]),
            ("<title-card>x</title-card><p>y</p>", ["x", "y"]), ("<style-guide><p>z</p></style-guide>", ["z"]),
            ("<p>a<script src=x/>var</script>b</p>", ["ab"]), ("<STYLE>p{}</STYLE>v", ["v"])):
        assert [x for x, _ in extract.page_lines(html)] == want, html


def test_pages_of_many_lines(spark):
    """Without an article every line is differenced; the work follows the lines."""
    own = [[f"line {k} of page {i}" for k in range(20_000)] for i in range(2)]
    html = ["<p>shared top</p>" + "".join(f"<p>{x}</p>" for x in lines) + "<p>shared end</p>" for lines in own]
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(html)]
    got = {r.page_id: r.text for r in extract.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: "\n".join(lines) for i, lines in enumerate(own)}


def test_texts_are_made_tokens_once_for_their_windows(spark):
    docs = spark.createDataFrame([(1, "Anna ran 5 km in May."), (2, "two words"), (3, "")], "doc_id long, text string")
    for kind, passes in ((decontaminate.NAMES, 3), (decontaminate.FOLDED, 4)):
        tokens, raw = decontaminate._seen("text", kind)
        seen = docs.select("doc_id", tokens.alias("tokens"), *([raw.alias("raw")] if kind == decontaminate.FOLDED else []))
        windows = decontaminate._windows(seen, "doc_id", 5, kind)
        assert windows._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == passes
        assert [tuple(r) for r in windows.select("doc_id", "place").collect()] == [(1, 0), (1, 1)]
