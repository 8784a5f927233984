"""Main text of web pages, by wrappers inferred for each host.

A page is a stream of tags and text slots.  Its *structure* is the stream
without texts, with repeated neighbours folded into one group.  Structures of a
host that can be aligned form a *template*, and have one wrapper, a union-free
regular expression: they are aligned one after the other; tokens that all share
stay, a stretch that some lack becomes an optional group, and a stretch that
occurs again beside itself a repeated group.  Every structure is then matched
against the finished wrapper, which gives each of its text slots a slot of the
wrapper, and these are judged over all pages that fill them.  Names of the
enclosing elements label slots: those in menus, headers, footers, sidebars,
notices, adverts, forms, comments and code are not main text, nor, in
structures without a marked article, slots whose text is mostly links or the
same on all distinct pages; if nothing else is left, the same text counts.
Extraction gives the texts that a page has in main slots of the wrapper.

Wrappers grow with the variety of a host's structures, not with its pages:
equal structures and their slots are counted before the shuffle, so a host with
a third of all pages is as many rows as any other.  Structures of a host are
aligned in buckets of bounded size, and the buckets' wrappers level by level, so
that no task holds a whole host; each structure is then matched on its own.

Rows: one for each input row, repeated rows alike; an empty table has none.
Null and empty pages, and pages without text, give an empty text; pages of any
length are read whole.  Pages without a host (null URL, no ``://``) count as one
host.  Markup may be cut off or unclosed anywhere.  Only the id, URL and HTML
columns are read; others can have any name.
"""

from __future__ import annotations

import functools
import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxgraph.llm import kernels as K
from voxgraph.llm.urlfilter import split_url
from voxgraph.plans.lineage import cut

#: Structures (of all hosts) up to which the table of main slots is sent to every executor; beyond, it is joined by a shuffle.
BROADCAST_HOSTS = 100_000
#: Structures can be aligned if this share of the tags of the smaller one aligns.
LEAST_ALIGNED = 0.7

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_MARKED = re.compile(r"class|id|role|itemprop", re.IGNORECASE)

_HAVING = re.compile(r"(?:no|has|with|without)[-_]", re.IGNORECASE)

# Kinds of elements, by name.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr img".split())
NOT_TEXT = frozenset("head script style noscript template iframe object embed applet svg math canvas audio video map title".split())
NOT_MAIN = frozenset("nav header footer aside form button select option input textarea label fieldset menu dialog".split())
# Words in class, id or role that mark what is not main text, and what is.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer foot sidebar side aside "
    "complementary contentinfo notice notices cookie cookies consent popup modal alert gdpr comment comments reply replies discussion disqus respond form search searchbox login signup newsletter subscribe "
    "subscription share sharing social related recommended recommendations widget pagination pager toolbar skip copyright legal tags".split()
)
MAIN_WORDS = frozenset("article articlebody main content post entry story".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements at whose start an open paragraph ends.
BLOCKS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())


def _label(name: str, attributes: str) -> str:
    """An element as a step of a path: its name, and the words of its class, id, role and itemprop."""
    if "=" not in attributes or not _MARKED.search(attributes):
        return name
    words: list[str] = []
    for m in _ATTRIBUTE.finditer(attributes):
        # What an element has or lacks (has-sidebar) says nothing of itself.
        own = " ".join(t for t in (m[2] or m[3] or m[4] or "").split() if not _HAVING.match(t))
        words += [w for w in re.split(r"[^a-zA-Z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", own)) if w]
    return ".".join([name, *dict.fromkeys(w.lower() for w in words)])


def slots(page: str) -> Iterator[tuple[str, str | None]]:
    """(path, text) of the text runs in order, and (label of a tag, None) for each tag; inline elements are no part of a path but ``a``."""
    stack: list[tuple[str, str]] = []
    at, links, path, size = 0, 0, "", len(page)
    search = _TOKEN.search
    while at <= size:
        m = search(page, at)
        end = m.start() if m else size
        if end > at:
            yield path + "/a" if links else path, page[at:end]
        if not m:
            return
        at = m.end()
        closing, name, attributes = m.groups()
        if not name:
            continue
        name = name.lower()
        if closing:
            if name == "a":
                links = 0
            if name in INLINE:
                yield f"/{name}", None
                continue
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    path = "/".join([x for _, x in stack])
                    break
                if stack[i][0] in ("article", "main", "body", "table") and name in ("p", "li", "div", "span"):
                    break
            yield f"/{name}", None
            continue
        if name in INLINE:
            links = 1 if name == "a" else links
            yield name, None
            continue
        label = _label(name, attributes)
        yield label, None
        if name in VOID or attributes.endswith("/"):
            continue
        for other in CLOSES.get(name, ()):
            if stack and stack[-1][0] == other:
                stack.pop()
        if name in BLOCKS and stack and stack[-1][0] == "p":
            stack.pop()
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            at = close.end() if close else len(page) + 1
            continue
        stack.append((name, label))
        path = "/".join([x for _, x in stack])


def step_kind(label: str) -> int:
    """-1: what is below is not main text; 1: it is; 0: neither."""
    name, *words = label.split(".")
    if name in NOT_TEXT or name in NOT_MAIN or (name not in ("body", "html", "article", "main") and ASIDE_WORDS.intersection(words)):
        return -1
    # Words on the page's own elements say what kind of page it is, not where its text stands.
    return 1 if name in ("article", "main") or (name not in ("body", "html") and MAIN_WORDS.intersection(words)) else 0


_SKIPPED = frozenset(x + n for n in INLINE for x in ("", "/"))


@functools.lru_cache(maxsize=1 << 14)
def slot_token(path: str) -> str:
    """Token of a text slot below these elements: ``#!`` is not main text, ``#*`` is marked as main, ``#`` is neither."""
    kinds = [step_kind(s) for s in path.split("/") if s and s != "a"]
    return "#!" if -1 in kinds else "#*" if 1 in kinds else "#"


def structure(found: list[tuple[str, str | None]]) -> list[str]:
    """Tags and text slots, with repeated neighbours folded."""
    return located(found)[0]


def located(found: list[tuple[str, str | None]]) -> tuple[list[str], list[int]]:
    """The structure, and for each text that is not blank the position of its slot; texts of one block share a slot."""
    tokens = [slot_token(x) if text is not None else x for x, text in found if (not text.isspace() if text is not None else x.partition(".")[0] not in _SKIPPED)]
    out, at = folded(tokens)
    return out, [i for i, t in zip(at, tokens, strict=True) if t[0] == "#"]


def fold(tokens: list[str]) -> list[str]:
    """Stretches that stand beside an equal stretch are kept once, marked as repeated."""
    return folded(tokens)[0]


_MODULUS, _BASE = (1 << 31) - 1, 0x1F3D5B79


def folded(tokens: list[str]) -> tuple[list[str], list[int]]:
    """What ``fold`` gives, and where each token went.

    A stretch can be of any length, and the shortest that stands beside its equal is folded first.  One of length n has a last part
    of 4**k tokens, 4**k <= n < 4**(k+1), that stands n before its end as well: only those places are looked at, for each k.  As what
    is kept never holds two equal stretches side by side, such a part can stand there a few times at most, so that a page of n tokens
    takes n log n steps.  Sums of parts only say where to look.
    """
    out: list[str] = []
    bare: list[str] = []
    held: list[list[int]] = []
    sums, power = [0], [1]
    ends: list[dict[int, list[int]]] = []  # by k: where parts of 4**(k+1) tokens end, by their sums
    listed: list[list[list[int]]] = []  # for each place the lists that it is in
    for at, t in enumerate(tokens):
        name = t.rstrip("+")
        out.append(t)
        bare.append(name)
        held.append([at])
        sums.append((sums[-1] * _BASE + hash(name)) % _MODULUS)
        if len(power) < len(sums):
            power.append(power[-1] * _BASE % _MODULUS)
        size, n = len(out), 0
        for short in (1, 2, 3):
            if 2 * short <= size and bare[-1 - short] == name and bare[-short:] == bare[-2 * short : -short]:
                n = short
                break
        own: list[list[int]] = []
        part, last = 4, sums[size]
        while part <= size:
            if len(ends) == len(own):
                ends.append({})
            places = ends[len(own)].setdefault((last - sums[size - part] * power[part]) % _MODULUS, [])
            if places and not n:
                for end in reversed(places):
                    far = size - end
                    if far >= 4 * part or 2 * far > size:
                        break
                    if far >= part and bare[-far:] == bare[-2 * far : -far]:
                        n = far
                        break
            places.append(size)
            own.append(places)
            part *= 4
        listed.append(own)
        if n:
            for x, y in zip(held[-2 * n : -n], held[-n:], strict=True):
                x += y
            for lists in listed[-n:]:
                for places in lists:
                    places.pop()
            del bare[-n:], out[-n:], held[-n:], sums[-n:], listed[-n:]
            out[-n] = out[-n].rstrip("+") + "+"
    went = [0] * len(tokens)
    for i, own_at in enumerate(held):
        for at in own_at:
            went[at] = i
    return out, went


def _bare(t: str) -> str:
    return t.rstrip("+?")


#: Product of the tokens of two structures beyond which their common ends are set aside before they are matched.
LONG_PAIR = 1 << 24


def match(wrapper: list[str], page: list[str]) -> dict[int, int]:
    """Positions in the page's structure with their positions in the wrapper."""
    a, b = [_bare(t) for t in wrapper], [_bare(t) for t in page]
    if a == b:  # the usual case, and a page alone, however long
        return {i: i for i in range(len(a))}
    head = tail = 0
    if len(a) * len(b) > LONG_PAIR:  # what both begin and end with belongs together; the matcher's time grows with the product of the rest
        least = min(len(a), len(b))
        head = next((i for i in range(least) if a[i] != b[i]), least)
        tail = next((i for i in range(least - head) if a[-1 - i] != b[-1 - i]), least - head)
    found = SequenceMatcher(None, a[head : len(a) - tail], b[head : len(b) - tail], autojunk=False).get_matching_blocks()
    out = {j + k + head: i + k + head for i, j, n in found for k in range(n)}
    out.update((i, i) for i in range(head))
    out.update((len(b) - 1 - i, len(a) - 1 - i) for i in range(tail))
    return out


def alignable(wrapper: list[str], page: list[str]) -> bool:
    """Whether a structure belongs to a wrapper's template; those without tags are one."""
    a, b = (Counter(x for t in tokens if (x := _bare(t))[0] != "#") for tokens in (wrapper, page))
    least = LEAST_ALIGNED * min(a.total(), b.total())
    if not a or not b or (a & b).total() < least:
        return not a and not b
    return sum(page[j][0] != "#" for j in match(wrapper, page)) >= least


def align(wrapper: list[str], page: list[str]) -> list[str]:
    """The wrapper extended so that it describes the page too: what only one of them has becomes optional (``?``)."""
    bare = _bare
    a, b = [bare(t) for t in wrapper], [bare(t) for t in page]
    out: list[str] = []
    for op, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op == "equal":
            out += [bare(x) + "".join(s for s in "+?" if s in x[len(bare(x)) :] or s in y[len(bare(y)) :]) for x, y in zip(wrapper[i:j], page[k:m], strict=True)]
        else:
            out += [t if t.endswith("?") else t + "?" for t in [*wrapper[i:j], *page[k:m]]]
    return fold(out)


def _plain(text: str) -> str:
    return " ".join(html.unescape(text).split())


@dataclass
class Slot:
    """What the pages show of a slot of a wrapper: its token, least and greatest digest of its text and of the whole texts of its pages, characters and those of links."""

    token: str
    lo: int
    hi: int
    page_lo: int
    page_hi: int
    chars: int
    links: int

    def add(self, other: Slot) -> None:
        self.lo, self.hi = min(self.lo, other.lo), max(self.hi, other.hi)
        self.page_lo, self.page_hi = min(self.page_lo, other.page_lo), max(self.page_hi, other.page_hi)
        self.chars += other.chars
        self.links += other.links

    @property
    def same(self) -> bool:
        """Whether distinct pages have one text here."""
        return self.lo == self.hi and self.page_lo != self.page_hi


def main_slots(own: dict[int, Slot]) -> list[int]:
    """Positions of main slots in a structure, from what is known of its wrapper's slots."""
    if marked := [at for at, x in own.items() if x.token == "#*"]:
        return marked
    neutral = {at: x for at, x in own.items() if x.token == "#" and 2 * x.links <= x.chars}
    return [at for at, x in neutral.items() if not x.same] or list(neutral)


def extract(found: list[tuple[str, str | None]], at: list[int], main: frozenset[int] | set[int]) -> str:
    """Texts of the main slots, by the positions of the page's texts: blocks in page order, one line each."""
    blocks: list[list[str]] = [[]]
    place = iter(at)
    for label, text in found:
        if text is None:
            name = label.lstrip("/").split(".")[0]
            if name not in INLINE and blocks[-1]:
                blocks.append([])
        elif text.isspace() or next(place) in main:
            blocks[-1].append(text)
    return "\n".join(t for t in (_plain("".join(b)) for b in blocks) if t)


def _host(url: str | None) -> str:
    return split_url(url)[0]


def _key(tokens: list[str]) -> tuple[str, int]:
    shape = json.dumps(tokens)
    return shape, xxhash.xxh64_intdigest(shape) - (1 << 63)


def _observed(batch: pa.RecordBatch) -> Iterator[dict]:
    """What a batch shows of its hosts: distinct structures (position -1), and facts of each slot."""
    seen: dict[tuple[str, int, int], list] = {}
    for url, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        host, found = _host(url), list(slots(page.as_py() or ""))
        tokens, at = located(found)
        shape, key = _key(tokens)
        seen.setdefault((host, key, -1), [0, 0, 0, 0, 0, 0, 0, shape])[4] += 1
        whole = xxhash.xxh64_intdigest("\0".join([" ".join(t.split()) for _, t in found if t is not None and not t.isspace()])) - (1 << 63)
        own: dict[int, list] = {}
        for i, (path, text) in zip(at, ((x, t) for x, t in found if t is not None and not t.isspace()), strict=True):
            facts = own.setdefault(i, [xxhash.xxh64(), 0, 0])
            facts[0].update(text)
            facts[1] += len(text)
            facts[2] += len(text) if path == "a" or path.endswith("/a") else 0
        for i, (digest, chars, links) in own.items():
            h = digest.intdigest() - (1 << 63)
            x = seen.setdefault((host, key, i), [h, h, whole, whole, 0, 0, 0, None])
            x[:7] = [min(x[0], h), max(x[1], h), min(x[2], whole), max(x[3], whole), x[4] + 1, x[5] + chars, x[6] + links]
    if seen:
        cols = list(zip(*[(*k, *v) for k, v in seen.items()], strict=True))
        yield dict(zip(_SEEN.names, map(list, cols), strict=True))


_SEEN = pa.schema([("host", pa.string()), ("key", pa.int64()), ("at", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("page_lo", pa.int64()), ("page_hi", pa.int64()), ("pages", pa.int64()), ("chars", pa.int64()), ("links", pa.int64()), ("shape", pa.string())])


#: Structures or wrappers that one task aligns with each other.
FAN = 64


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """Wrappers of a bucket of structures, or of wrappers: those that can be aligned become one, named by its first (most pages, then in order)."""
    made: list[list[str]] = []
    first: list[int] = []
    pages: list[int] = []
    into: dict[int, int] = {}
    for r in rows.sort_values(["pages", "shape"], ascending=[False, True]).itertuples():
        tokens = json.loads(r.shape)
        n = next((i for i, w in enumerate(made) if alignable(w, tokens)), len(made))
        if n == len(made):
            made.append(tokens)
            first.append(r.id)
            pages.append(r.pages)
        else:
            made[n] = align(made[n], tokens)
            pages[n] += r.pages
        into[r.id] = n
    own = list(into)
    kept = [i == first[n] for i, n in into.items()]
    return pd.DataFrame({
        "host": rows.host.iloc[0], "id": own, "into": [first[n] for n in into.values()],
        "shape": [json.dumps(made[n]) if k else None for k, n in zip(kept, into.values(), strict=True)], "pages": [pages[n] if k else 0 for k, n in zip(kept, into.values(), strict=True)],
    })


def templates(shapes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((host, key, id) of every structure, (host, id, wrapper) of every template) from rows (host, key, shape, pages).

    Structures of a host are dealt over buckets of about ``FAN``; the wrappers of the buckets are merged in the same way,
    level by level, until a host has one bucket left.
    """
    level = shapes.select("host", F.col("key").alias("id"), "shape", "pages")
    ids = shapes.select("host", "key", F.col("key").alias("id"))
    before = None
    while True:
        sizes = cut(level.groupBy("host").agg(F.count("*").alias("size")))
        total, most = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
        last = most <= FAN or total == before  # where nothing more merges, what is left are templates, which meet once
        buckets = F.lit(1) if last else F.ceil(F.col("size") / FAN)
        dealt = level.join(sizes, "host").withColumn("bucket", F.pmod(F.xxhash64("id"), buckets.cast("long")))
        merged = cut(dealt.groupBy("host", "bucket").applyInPandas(_merge, "host string, id long, into long, shape string, pages long"))
        ids = ids.join(merged.select("host", "id", "into"), ["host", "id"]).select("host", "key", F.col("into").alias("id"))
        level = merged.where("id = into").select("host", "id", "shape", "pages")
        if last:
            return cut(ids), level.select("host", "id", F.col("shape").alias("wrapper"))
        ids, before = cut(ids), total


def _slots_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """Of each structure matched against its wrapper: its text slots, with the slot of the wrapper, or their own where folding took the token out of the wrapper."""
    out: dict[str, list] = {f.name: [] for f in _PLACED}
    for host, key, id_, shape, wrapper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        tokens, of = json.loads(shape), match(json.loads(wrapper), json.loads(shape))
        for at, t in enumerate(tokens):
            if t[0] == "#":
                for name, x in zip(_PLACED.names, (host, key, id_, at, of.get(at, at), 0 if at in of else key, _bare(t)), strict=True):
                    out[name].append(x)
    yield out


_PLACED = pa.schema([("host", pa.string()), ("key", pa.int64()), ("id", pa.int64()), ("at", pa.int64()), ("slot", pa.int64()), ("own", pa.int64()), ("token", pa.string())])
_FACTS = ("lo", "hi", "page_lo", "page_hi", "chars", "links")


def _main_of(batch: pa.RecordBatch) -> Iterator[dict]:
    known = [{x["at"]: Slot(x["token"], *(x[c] for c in _FACTS)) for x in group} for group in batch.column(2).to_pylist()]
    yield {"host": batch.column(0), "key": batch.column(1), "main": [sorted(main_slots(x)) for x in known]}


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, key long, main array<long>) of every structure that has texts: its digest and the positions of its main slots."""
    seen = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInArrow(K.mapper(_observed, _SEEN), "host string, key long, at long, lo long, hi long, page_lo long, page_hi long, pages long, chars long, links long, shape string")

    def summed(df: DataFrame, *by: str) -> DataFrame:
        return df.groupBy(*by).agg(*(F.min(c).alias(c) for c in ("lo", "page_lo")), *(F.max(c).alias(c) for c in ("hi", "page_hi")), *(F.sum(c).alias(c) for c in ("chars", "links")), *([F.sum("pages").alias("pages"), F.max("shape").alias("shape")] if "at" in by else []))

    facts = cut(summed(seen, "host", "key", "at"))
    shapes = facts.where("at < 0").select("host", "key", "shape", "pages")
    ids, made = templates(shapes)
    against = shapes.join(ids, ["host", "key"]).join(made, ["host", "id"]).select("host", "key", "id", "shape", "wrapper")
    placed = cut(against.mapInArrow(K.mapper(_slots_of, _PLACED), "host string, key long, id long, at long, slot long, own long, token string"))
    by_slot = summed(placed.join(facts.where("at >= 0"), ["host", "key", "at"]), "host", "id", "slot", "own")
    of_structure = placed.join(by_slot, ["host", "id", "slot", "own"]).groupBy("host", "key").agg(F.collect_list(F.struct("at", "token", *_FACTS)).alias("slots"))
    schema = pa.schema([("host", pa.string()), ("key", pa.int64()), ("main", pa.list_(pa.int64()))])
    return of_structure.mapInArrow(K.mapper(_main_of, schema), "host string, key long, main array<long>")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    known = cut(wrappers(pages))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    ddl = "page_id long, url string, text string, n_chars long"

    def done(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    if known.count() <= broadcast_hosts:
        table = known.toArrow()
        # Structures share few lists of slots, so each list is kept once.
        lists: dict[tuple[int, ...], int] = {}
        index = {(h, k): lists.setdefault(tuple(m), len(lists)) for h, k, m in zip(*(table[c].to_pylist() for c in ("host", "key", "main")), strict=True)}
        shared = pages.sparkSession.sparkContext.broadcast((index, [frozenset(x) for x in lists]))

        def rows(batch: pa.RecordBatch) -> Iterator[dict]:
            of, sets = shared.value
            texts = []
            for url, page in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = list(slots(page.as_py() or ""))
                tokens, at = located(found)
                number = of.get((_host(url), _key(tokens)[1]))
                texts.append("" if number is None else extract(found, at, sets[number]))
            yield done(batch, texts)

        return pages.mapInArrow(K.mapper(rows, schema), ddl)

    keyed = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()), ("host", pa.string()), ("key", pa.int64())])

    def keys(batch: pa.RecordBatch) -> Iterator[dict]:
        own = [_key(structure(list(slots(p.as_py() or ""))))[1] for p in batch.column(2)]
        yield {"page_id": batch.column(0), "url": batch.column(1), "html": batch.column(2), "host": [_host(u) for u in batch.column(1).to_pylist()], "key": own}

    def joined(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = []
        for page, main in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
            found = list(slots(page.as_py() or ""))
            texts.append(extract(found, located(found)[1], set(main or ())))
        yield done(batch, texts)

    with_keys = pages.mapInArrow(K.mapper(keys, keyed), "page_id long, url string, html string, host string, key long")
    return with_keys.join(known, ["host", "key"], "left").select("page_id", "url", "html", "main").mapInArrow(K.mapper(joined, schema), ddl)
