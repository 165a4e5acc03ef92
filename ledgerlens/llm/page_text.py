"""Main text of web pages by differencing with the page of the nearest URL.

  1. A page becomes its text lines: one per block, with character references decoded and white space turned into
     single spaces.  Elements and names that hold no article (menus, adverts, forms, comments, ...) mark their lines.
  2. Pages are in order of (host, path, key); each is paired with the nearest different page on its host, before or
     behind it, whose path has more leading parts in common.  Copies of the page are passed over: they would take the
     article away with the frame.  The longest common subsequence of the two line lists aligns them, and shared lines go.
  3. Two checks follow.  Marked lines go even if no neighbour shares them, since an advert or menu may differ from page
     to page.  Lines of an <article> or <main> element stay even if shared, since an article may have a copy; where
     there is such an element only its lines stay, unless the lines beside it that no neighbour shares are longer.

Pages move once, to a task per range of (host, path, key), so a host or URL of any size is spread over many tasks.  The
pages of the REACH nearest different contents on either side of a range are also put into it, however many copies lie
between.  Where all of these and all of the range are copies of a page, its mate is looked up further on by the hashes of
lines, range by range, and put into the range as well; so the pairing does not depend on where ranges are cut.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.common import batches_of, short_batches, slices
from ledgerlens.llm.sequences import lcs_members
from ledgerlens.llm.url_filter import host_of, path_of
from ledgerlens.session import broadcast_if_small, cut_lineage

ROWS_PER_RANGE = 1_000
MOST_RANGES = 4_096
SAMPLED = 32  # keys drawn per range to place its bounds
BOUND_CHARS = 256
REACH = 4  # different contents beyond either end of a range that are put into it without being looked at
COPY = 0.8  # of the characters of both pages in shared lines: one is an edited copy of the other
NO_KEY = -1 << 63  # where a NULL key is in order

ARTICLE, PLAIN, MARKED = 0, 1, 2
# Element names of HTML by what they do here.
MAIN = {"article", "main"}
NO_TEXT = {"script", "style", "noscript", "template", "iframe", "svg", "head", "title", "object", "canvas", "math"}
NO_ARTICLE = {"nav", "aside", "footer", "form", "menu", "dialog", "button", "select", "textarea", "label", "fieldset"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
          "tt", "u", "var", "wbr", "img", "br"}
# Words in class and id that name parts outside an article.
NAMES = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
         "promotion", "banner", "nav", "navbar", "navigation", "menu", "submenu", "breadcrumb", "breadcrumbs", "header",
         "masthead", "topbar", "footer", "sidebar", "aside", "widget", "widgets", "rail", "cookie", "cookies", "consent",
         "gdpr", "notice", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup",
         "login", "form", "search", "share", "sharing", "social", "comment", "comments", "respond", "reply", "replies",
         "disqus", "related", "recommended", "recommendations", "pagination", "pager", "toolbar", "skip"}
ABOUT = {"has", "with", "no", "without"}  # the name tells of such a part beside the element
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|textarea|title)\b(?P<rest>[^>]*)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-z][^\s/>]*+)[^>]*+>"
    r"|<[!?][^>]*+>", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z]+")


def _marks(name: str, attributes: str, kind: int) -> bool:
    """Whether an element starts a part that is no article.  An outermost <article> or <main> never does."""
    if name in NO_ARTICLE or name in NO_TEXT or (name == "header" and kind != ARTICLE):
        return True
    if "=" not in attributes or name in ("html", "body") or (name in MAIN and kind != ARTICLE):
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        for token in "".join(values).split():
            words = set(WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token).lower()))
            if words & (ROLES if key.lower() == "role" else NAMES) and not words & ABOUT:
                return True
    return False


def text_lines(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of every block with text, in page order."""
    lines: list[tuple[int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements, with the kind of text inside them
    kind, at = PLAIN, 0
    page = page or ""

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                lines.append((kind, text))
            held.clear()

    for token in TOKEN.finditer(page):
        if token.start() > at:
            held.append(page[at:token.start()])
        at = token.end()
        name = token["name"] or token["name2"]
        if not name:
            if token["raw"] and token["raw"].lower() not in INLINE:
                flush()
            continue
        name, closing = name.lower(), bool(token["close"] or token["close2"])
        if name == "br":
            held.append(" ")
            continue
        if closing:
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if place is not None or name not in INLINE:
                flush()
            if place is not None:
                del stack[place:]
                kind = stack[-1][1] if stack else PLAIN
            continue
        marked = _marks(name, token["attributes"] or "", kind)
        if name in INLINE and not marked and not (stack and stack[-1][0] in INLINE):
            continue  # inline elements count only where one of them is marked
        if name not in INLINE or marked:
            flush()
        if name in VOID:
            continue
        if name == "body":
            stack, kind = [], PLAIN  # what was left open before it ends here
        kind = MARKED if marked or kind == MARKED else ARTICLE if name in MAIN else kind
        stack.append((name, kind))
    if at < len(page):
        rest = page[at:]
        held.append(rest[:rest.rindex("<")] if re.search(r"<[a-z/!][^>]*\Z", rest, re.I) else rest)
    flush()
    return lines


def shared_path(a: str, b: str) -> tuple[int, int]:
    """How near two paths are: common leading parts, then common leading characters."""
    parts = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        parts += 1
    chars = 0
    for x, y in zip(a, b):
        if x != y:
            break
        chars += 1
    return parts, chars


def article(kinds: list[int], texts: list[str], mate: list[str] | None) -> tuple[str, int]:
    """The text that stays, and how many lines the mate took away."""
    shared = set(lcs_members(texts, mate)) if mate else set()
    own = [i for i, k in enumerate(kinds) if k == ARTICLE]
    plain = [i for i, k in enumerate(kinds) if k == PLAIN and i not in shared]
    if own and sum(len(texts[i]) for i in own) >= sum(len(texts[i]) for i in plain):
        plain = []
    return "\n".join(texts[i] for i in sorted(own + plain)), sum(1 for i in shared if kinds[i] != ARTICLE)


def is_copy(page: dict, mate: dict) -> bool:
    """Whether a mate has every line that the page could keep, or either page is mostly made of lines of the other.

    `chars` has the characters of each line of a page, in all its places; `own` has the lines that are not marked.
    """
    here, there = page["chars"], mate["chars"]
    if page["own"] <= there.keys():
        return True
    shared = here.keys() & there.keys()
    return all(sum(a[t] for t in shared) >= COPY * sum(a.values()) for a in (here, there))


def _counted(kinds: list[int], lines: list[str]) -> tuple[dict[str, int], set[str]]:
    """Characters of each line in all its places, and the lines that are not marked."""
    chars: dict[str, int] = {}
    for t in lines:
        chars[t] = chars.get(t, 0) + len(t)
    return chars, {t for k, t in zip(kinds, lines) if k != MARKED}


def extract(df: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text, lines, shared) of every row: main text, number of text lines, lines the nearest page shares.

    NULL html counts as an empty page (empty text).  A NULL url or one without `://` has an empty host: such pages are
    neighbours of each other only by their empty path.  Rows with equal URLs are in order of their key; repeated rows
    stay.  A page without a different one on its host keeps all lines that are not marked.  Other columns are not read.
    """
    short_batches(df.sparkSession)
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.col(page).alias("html"),
                     host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
                     F.xxhash64(F.col(page)).alias("content"))
    light = rows.select("host", "path", "key", "content")
    bounds = _bounds(light)
    ends = _ends(light, bounds)
    guests = _guests(ends)
    rows = _with_far(rows, bounds, guests, ends)
    order = pa.schema([("range", pa.int32()), ("guest", pa.bool_()), ("host", pa.string()), ("path", pa.string()),
                       ("key", pa.int64()), ("content", pa.int64()), ("url", pa.string()), ("kinds", pa.binary()),
                       ("lines", pa.list_(pa.string()))])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pages() -> Iterator[tuple]:
            for whole in batches:
                for batch in slices(whole, "html", 8 << 20):
                    for row in zip(*[batch.column(c).to_pylist() for c in ("key", "url", "html", "host", "path", "content", "far")]):
                        k, u, h, host, path, content, far = row
                        lines = text_lines(h)
                        cells = (host, path, k, content, u, bytes(kind for kind, _ in lines), [text for _, text in lines])
                        own = bisect_left(bounds, _place(host, path, k))
                        yield own, False, *cells
                        for other in {*guests.get((host, path, k), ()), *(far or ())} - {own}:
                            yield other, True, *cells
        yield from batches_of(pages(), order, lambda r: 64 + sum(map(len, r[8])))

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            for now, mates in _paired(_rows(batches)):
                mate = max((m for m in mates if m), key=lambda m: shared_path(now["path"], m["path"]), default=None)
                text, taken = article(list(now["kinds"]), now["lines"], mate and mate["lines"])
                yield now["key"], now["url"], text, len(now["lines"]), taken
        yield from batches_of(results(), out, lambda r: len(r[2]))

    out = pa.schema([("key", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("lines", pa.int32()),
                     ("shared", pa.int32())])
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (rows.mapInArrow(parse, "range int, guest boolean, host string, path string, key long, content long, "
                                      "url string, kinds binary, lines array<string>")
               .repartition(parts, "range").sortWithinPartitions("range", "host", "path", "key", "guest"))
    done = ordered.mapInArrow(pair, "key long, url string, text string, lines int, shared int")
    return done.select(F.col("key").alias(key), F.col("url").alias(url), "text", "lines", "shared")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            for row in batch.slice(start, 256).to_pylist():
                if "lines" in row:
                    row["chars"], row["own"] = _counted(row["kinds"], row["lines"])
                else:
                    row["chars"], row["own"] = dict(zip(row["hashes"], row["sizes"])), {*row["unmarked"]}
                yield row


def _paired(rows: Iterator[dict]) -> Iterator[tuple[dict, tuple]]:
    """Each row that is no guest, with the nearest different page on either side of it on its host (None without one).

    `seen` has the contents of the range so far, the latest last.  `waiting` has what waits for a page behind it, rows of
    one content that follow each other together: (first row, the rows with the page before them, contents passed over).
    """
    place, seen, waiting = None, {}, []
    for now in rows:
        if (now["range"], now["host"]) != place:
            for _, group, _ in waiting:
                yield from ((r, (m, None)) for r, m in group)
            place, seen, waiting = (now["range"], now["host"]), {}, []
        content, still = now["content"], []
        for entry in waiting:
            first, group, passed = entry
            if content == first["content"] or content in passed:
                still.append(entry)
                continue
            if is_copy(first, now):
                passed.add(content)
                still.append(entry)
            else:
                yield from ((r, (m, now)) for r, m in group)
        waiting = still
        before = waiting[-1] if waiting and waiting[-1][0]["content"] == content and not waiting[-1][2] else None
        if before:
            now |= {c: before[0][c] for c in ("kinds", "lines", "chars", "own") if c in now}  # held once
        near = seen.pop(content, None)
        if not now["guest"]:
            if near is not None and before and before[1]:
                mate = before[1][-1][1]
            else:
                mate = next((m for m in reversed(seen.values()) if not is_copy(now, m)), None)
            if before:
                before[1].append((now, mate))
            else:
                waiting.append((now, [(now, mate)], set()))
        seen[content] = now
    for _, group, _ in waiting:
        yield from ((r, (m, None)) for r, m in group)


def _place(host: str, path: str, key: int | None) -> tuple[str, str, int]:
    return host[:BOUND_CHARS], path[:BOUND_CHARS], NO_KEY if key is None else key


def _bounds(light: DataFrame) -> list[tuple[str, str, int]]:
    """Ascending (host, path, key) bounds of ranges of about equal size, from a bounded sample; results do not hang on them."""
    n = light.count()
    ranges = min(MOST_RANGES, -(-n // ROWS_PER_RANGE))
    if ranges < 2:
        return []
    wanted = ranges * SAMPLED
    cut = light.select(F.substr("host", F.lit(1), F.lit(BOUND_CHARS)).alias("host"),
                       F.substr("path", F.lit(1), F.lit(BOUND_CHARS)).alias("path"), "key")
    drawn = cut.where(F.pmod(F.xxhash64("key", "host", "path"), F.lit(n)) < wanted).select("host", "path", "key").limit(4 * wanted)
    keys = sorted(_place(r["host"], r["path"], r["key"]) for r in drawn.collect())  # at most 4 * MOST_RANGES * SAMPLED short keys
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def _ends(light: DataFrame, bounds: list[tuple[str, str, int]]) -> list:
    """Per range, in order, the pages of REACH + 1 different contents at either end."""
    if not bounds:
        return []
    keys = pa.schema([("range", pa.int32()), ("host", pa.string()), ("path", pa.string()), ("key", pa.int64()), ("content", pa.int64())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [batch.column(c).to_pylist() for c in ("host", "path", "key")]
            own = [bisect_left(bounds, _place(*row)) for row in zip(*cells)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *batch.columns], schema=keys)

    place = F.struct("host", "path", "key", "content")
    contents = (light.mapInArrow(number, "range int, host string, path string, key long, content long")
                .groupBy("range", "host", "content").agg(F.min(place).alias("first"), F.max(place).alias("last")))
    some = lambda name, up: F.slice(F.sort_array(F.collect_list(name), up), 1, REACH + 1).alias(name)
    return sorted(contents.groupBy("range").agg(some("first", True), some("last", False)).collect(),
                  key=lambda r: r["range"])  # REACH + 1 rows at either end of at most MOST_RANGES


def _guests(ends: list) -> dict[tuple, list[int]]:
    """Ranges that a page is put into beside its own: those whose first or last page has it among the REACH nearest
    different contents before or behind it."""
    guests: dict[tuple, list[int]] = {}
    for side, way in (("last", -1), ("first", 1)):
        other = "first" if side == "last" else "last"
        for i, r in enumerate(ends):
            host, met, at = r[other][0]["host"], set(), i + way
            while 0 <= at < len(ends) and len(met) <= REACH and ends[at][side][0]["host"] == host:
                for page in ends[at][side]:
                    if page["host"] == host and page["content"] not in met and len(met) <= REACH:
                        met.add(page["content"])
                        guests.setdefault((page["host"], page["path"], page["key"]), []).append(r["range"])
                at += way
    return guests


LIGHT = ("range int, guest boolean, host string, path string, key long, content long, hashes array<long>, "
         "sizes array<int>, unmarked array<long>")


def _with_far(rows: DataFrame, bounds: list[tuple[str, str, int]], guests: dict[tuple, list[int]], ends: list) -> DataFrame:
    """`rows` with `far`: ranges that a page is put into because it is the nearest different page of one whose range and
    guests are all copies of it.

    Pages are held by the hashes of their lines for that.  What has found no mate is sent to the ranges of its host that lie
    1, then 2 to 3, then 4 to 7 ... behind its own, so that each task holds the lines of one range only.
    """
    none = rows.withColumn("far", F.lit(None).cast("array<int>"))
    reach = _reach(ends)
    if not any(low < at or high > at for at, (low, high) in reach.items()):
        return none
    held = pa.schema([("range", pa.int32()), ("guest", pa.bool_()), ("host", pa.string()), ("path", pa.string()), ("key", pa.int64()),
                      ("content", pa.int64()), ("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("unmarked", pa.list_(pa.int64()))])
    asked = pa.schema([("side", pa.int32()), *[f for f in held if f.name != "guest"]])
    found = pa.schema([("side", pa.int32()), *[held.field(c) for c in ("range", "host", "content")],
                       *[pa.field(f"mate_{c}", held.field(c).type) for c in ("host", "path", "key", "content")]])
    size = lambda r: 64 + 20 * len(r[-2])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pages() -> Iterator[tuple]:
            for whole in batches:
                for batch in slices(whole, "html", 8 << 20):
                    for host, path, k, content, h in zip(*[batch.column(c).to_pylist() for c in ("host", "path", "key", "content", "html")]):
                        lines = text_lines(h)
                        chars, own = _counted([kind for kind, _ in lines], [text for _, text in lines])
                        marks = {t: int.from_bytes(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True) for t in chars}
                        cells = (host, path, k, content, list(marks.values()), list(chars.values()), [marks[t] for t in own])
                        at = bisect_left(bounds, _place(host, path, k))
                        yield at, False, *cells
                        for other in guests.get((host, path, k), ()):
                            yield other, True, *cells
        yield from batches_of(pages(), held, size)

    def unmatched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages without a mate on a side (-1 before, 1 behind) on which their host goes on in the next range."""
        def pages() -> Iterator[tuple]:
            for now, mates in _paired(_rows(batches)):
                low, high = reach[now["range"]]
                for side, mate, more in ((-1, mates[0], low < now["range"]), (1, mates[1], high > now["range"])):
                    if mate is None and more:
                        yield side, *[now[f.name] for f in list(asked)[1:]]
        yield from batches_of(pages(), asked, size)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nearest different page in a range for each page sent there; the pages of a range come first."""
        def mates() -> Iterator[tuple]:
            at, pages = None, {}
            for now in _rows(batches):
                if now["target"] != at:
                    at, pages = now["target"], {}
                if now["side"] == 0:
                    pages.setdefault(now["host"], []).append(now)
                    continue
                here = pages.get(now["host"], [])
                for mate in here if now["side"] > 0 else reversed(here):
                    if mate["content"] != now["content"] and not is_copy(now, mate):
                        yield (now["side"], now["range"], now["host"], now["content"], *[mate[c] for c in ("host", "path", "key", "content")])
                        break
        yield from batches_of(mates(), found, lambda r: 64 + len(r[2]) + len(r[5]))

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pages = cut_lineage(rows.select("host", "path", "key", "content", "html").mapInArrow(parse, LIGHT))
    side = ", ".join(f"{f.name} {dict(f.split(' ') for f in LIGHT.split(', '))[f.name]}" for f in asked if f.name != "side")
    todo = cut_lineage(pages.repartition(parts, "range").sortWithinPartitions("range", "host", "path", "key", "guest")
                       .mapInArrow(unmatched, f"side int, {side}").dropDuplicates(["side", "range", "host", "content"]))
    mates, near = None, 1
    while todo.limit(1).count():
        targets = F.filter(F.sequence(F.lit(near), F.lit(2 * near - 1)), lambda d: _between(F.col("range") + F.col("side") * d, reach))
        sent = todo.withColumn("target", F.explode(targets)).withColumn("target", F.col("range") + F.col("side") * F.col("target"))
        there = pages.where("not guest").drop("guest").withColumn("side", F.lit(0)).withColumn("target", F.col("range"))
        there = there.join(F.broadcast(sent.select("target").distinct()), "target", "left_semi")
        new = cut_lineage(there.unionByName(sent).repartition(parts, "target")
                          .sortWithinPartitions("target", F.col("side") != 0, "host", "path", "key")
                          .mapInArrow(matched, "side int, range int, host string, content long, mate_host string, mate_path string, "
                                               "mate_key long, mate_content long"))
        place = F.struct(*[F.col(f"mate_{c}").alias(c) for c in ("host", "path", "key", "content")])
        nearest = new.groupBy("side", "range", "host", "content").agg(
            F.when(F.col("side") < 0, F.max(place)).otherwise(F.min(place)).alias("mate"))
        some = nearest.select("range", "mate.*")
        mates = some if mates is None else mates.unionByName(some)
        keys = ["side", "range", "host", "content"]
        known = new.select(*[F.col(c).alias(f"k_{c}") for c in keys]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in keys]
        near *= 2
        todo = cut_lineage(todo.join(known, same, "left_anti").where(_between(F.col("range") + F.col("side") * near, reach)))
    if mates is None:
        return none
    far = broadcast_if_small(mates.groupBy("host", "path", "key", "content").agg(F.collect_set("range").alias("far")).select(
        *[F.col(c).alias(f"m_{c}") for c in ("host", "path", "key", "content")], "far"))
    return rows.join(far, [F.col(c).eqNullSafe(F.col(f"m_{c}")) for c in ("host", "path", "key", "content")], "left").select(rows["*"], "far")


def _reach(ends: list) -> dict[int, tuple[int, int]]:
    """By range, the first range that the host of its first page is in, and the last one that the host of its last page is in."""
    low = {r["range"]: r["range"] for r in ends}
    high = dict(low)
    for a, b in zip(ends, ends[1:]):
        if a["last"][0]["host"] == b["first"][0]["host"]:
            low[b["range"]] = low[a["range"]] if a["first"][0]["host"] == a["last"][0]["host"] else a["range"]
    for b, a in zip(ends[::-1], ends[-2::-1]):
        if a["last"][0]["host"] == b["first"][0]["host"]:
            high[a["range"]] = high[b["range"]] if b["first"][0]["host"] == b["last"][0]["host"] else b["range"]
    return {r: (low[r], high[r]) for r in low}


def _between(target: Column, reach: dict[int, tuple[int, int]]) -> Column:
    """Whether a page's host may go on in the target range."""
    most = max(reach) + 1
    low, high = (F.array(*[F.lit(reach.get(r, (r, r))[k]) for r in range(most)]) for k in (0, 1))
    return target.between(low[F.col("range")], high[F.col("range")])
