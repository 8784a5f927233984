"""Folding against a plain version, long pages, and marks on the page's own elements."""

import random
import time

from voxgraph.llm import htmltext


def plain_fold(tokens):
    """Every pair of neighbouring stretches compared, the shortest first."""
    out, bare, held = [], [], []
    for at, t in enumerate(tokens):
        out.append(t)
        bare.append(t.rstrip("+"))
        held.append([at])
        for n in range(1, len(bare) // 2 + 1):
            if bare[-n:] == bare[-2 * n : -n]:
                for x, y in zip(held[-2 * n : -n], held[-n:]):
                    x += y
                del bare[-n:], out[-n:], held[-n:]
                out[-n] = out[-n].rstrip("+") + "+"
                break
    went = [0] * len(tokens)
    for i, own in enumerate(held):
        for at in own:
            went[at] = i
    return out, went


def test_folding_equals_the_plain_version():
    r = random.Random(1)
    for _ in range(1500):
        names = "abcdefgh"[: r.choice([1, 2, 3, 4, 8])]
        tokens = [r.choice(names) for _ in range(r.randint(0, 60))]
        if r.random() < 0.5:
            tokens = tokens * r.randint(1, 4) + tokens[: r.randint(0, 9)]
        assert htmltext.folded(tokens) == plain_fold(tokens)


def varied(size):
    r, parts = random.Random(2), []
    shapes = ["<p>{}</p>", "<div><h2>{}</h2><p>{}</p></div>", "<ul><li>{}</li><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<table><tr><td>{}</td></tr></table>", "<h3>{}</h3>"]
    while sum(map(len, parts[-1:])) and len(parts) * 40 < size or not parts:
        parts.append(r.choice(shapes).replace("{}", f"text {len(parts)} of words and more"))
    return "<html><body><nav>Home</nav><article>" + "".join(parts) + "</article></body></html>"


def test_time_grows_with_the_page():
    """Eight times the page takes about eight times as long, not sixty-four times."""
    took = []
    for size in (60_000, 480_000):
        page = varied(size)
        began = time.process_time()
        htmltext.located(list(htmltext.slots(page)))
        took.append(time.process_time() - began)
    assert took[1] < 24 * took[0] + 0.5


def test_two_megabytes_in_one_page(spark):
    page = varied(2_000_000)
    got = htmltext.main_text(spark.createDataFrame([(1, "https://a.example/1", page), (2, "https://a.example/2", "<p>short</p>")], "page_id long, url string, html string")).orderBy("page_id").collect()
    assert got[0].n_chars > 800_000 and got[0].text.startswith("text 0 of words and more") and "Home" not in got[0].text


def test_class_words_of_the_body_are_no_marks(spark):
    """A page's own elements say what kind of page it is; its text is found as without those words."""
    def pages(body):
        rows = [(i, f"https://b.example/{i}", f"<html><body{body}><ul><li><a href='/'>Home</a></li><li><a href='/about'>About us</a></li></ul><h1>Title {i}</h1><p>Body {i} with some words of its own.</p><div><a href='/x'>Other one</a> <a href='/y'>Other two</a></div></body></html>") for i in range(6)]
        return htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()

    marked, bare = pages(" class='single single-post post article'"), pages("")
    assert [r.text for r in marked] == [r.text for r in bare] == [f"Title {i}\nBody {i} with some words of its own." for i in range(6)]
