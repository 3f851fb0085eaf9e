"""HTML main text by equivalence-class template deduction over the pages of a host."""

from __future__ import annotations

import hashlib
import html as htmllib
import re
from collections import Counter, defaultdict
from typing import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesnet.llm.common import checkpointed, out_batch, pieces, text_of

VALID_SHARE = 0.5             # share of a host's pages that the tokens of a valid class reach
BROADCAST_BYTES = 32 << 20    # templates are broadcast below this measured size, else joined
MIN_MASS = 0.7
MIN_PAGES = 5                 # text that recurs on every page of a host is template text from this many pages

# HTML vocabulary.
STRUCTURE = set("""html head body main article section div nav header footer aside form fieldset table thead tbody tfoot
tr td th caption ul ol li dl dt dd p h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption address details summary dialog
menu hr title""".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = STRUCTURE - {"html", "head", "body", "title"}
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
P_LIMITS = {"td", "th", "li", "div", "article", "section"}
LIST_LIMITS = {"ul", "ol", "dl", "table", "menu"}
VOID = {"hr"}
# Elements that are never main text, and the whole words in class, id or role that mark such elements.
NOT_TEXT_TAGS = set("head nav aside footer form fieldset menu dialog title".split())
NOT_TEXT_WORDS = set("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies
consent gdpr notice notices alert popup modal overlay sidebar side aside comment comments reply replies respondents
discussion disqus share sharing social related recommended newsletter subscribe subscription signup login breadcrumb
breadcrumbs menu nav navbar navigation topbar toolbar footer widget widgets pagination pager hidden
contentinfo complementary search""".split())
# A compound such as cookie-notice or top-nav marks one too, if each part is such a word, a number or one of these.
QUALIFIERS = set("""top bottom left right main site page post posts article articles entry global primary secondary inner outer
box bar container wrapper wrap list item items section area block group unit slot space link links button buttons icon icons
header message policy law form title toggle panel""".split())
COMMENT_WORDS = set("comment comments reply replies respondents discussion disqus".split())
NEVER_BOILERPLATE = set("html body main article".split())
OUTSIDE_WORDS = {"header", "masthead", "site-header"}
MAIN_TAGS = {"article", "main"}
BOXES = {"div", "section", "details"}  # elements that may hold a notice or advert inside an article

# Elements skipped with all they hold, up to their end tag.
SKIPPED = set("script style noscript template textarea select svg iframe button object".split())

PATH_CHARS = 256  # longer paths begin with a hash of the element above, so deep pages take linear space

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>")
_TAG_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_END = {t: re.compile(rf"</{t}\s*+>", re.I) for t in SKIPPED}
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")


def _name(tag: str, attributes: str) -> str:
    """Tag with its class, id and role: the role that tells template tokens apart."""
    if not attributes.strip():
        return tag
    found: dict[str, str] = {}
    for k, v in _ATTRIBUTE.findall(attributes):
        found.setdefault(k.lower(), v.strip("\"'"))
    words = [w for k in ("class", "id", "role") for w in found.get(k, "").lower().split()]
    if "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        words.append("hidden")
    return ".".join([tag, *(w.replace("/", "_").replace(".", "_") for w in words)])


def _by_tag(tag: str, inside: bool) -> bool:
    return tag in NOT_TEXT_TAGS or (tag == "header" and not inside)


def _marks(word: str, inside: bool) -> set[str]:
    """The listed words a class word consists of: itself, or the parts of a compound of
    listed words, ``QUALIFIERS`` and numbers only."""
    listed = NOT_TEXT_WORDS if inside else NOT_TEXT_WORDS | OUTSIDE_WORDS
    if word in listed:
        return {word}
    parts = {p for p in re.split(r"[-_]+", word) if p}
    return parts & listed if all(p in listed or p in QUALIFIERS or p.isdigit() for p in parts) else set()


def _is_boilerplate(name: str, inside: bool) -> bool:
    """Whether an element holds no main text by its name; ``inside``: below the main element."""
    tag, *words = name.split(".")
    return tag not in NEVER_BOILERPLATE and (_by_tag(tag, inside) or any(_marks(w, inside) for w in words))


def _above(path: str, long: dict[str, str]) -> str:
    """Path of the element above; ``long`` has it for paths beyond ``PATH_CHARS``."""
    return long[path] if path in long else path.rsplit("/", 1)[0]


def outline(paths: Iterable[str], long: dict[str, str]) -> dict[str, int]:
    """Depth of each path and of all above it, in an order that has elements after the one above."""
    depth = {"": 0}
    for path in paths:
        chain = []
        while path not in depth:
            chain.append(path)
            path = _above(path, long)
        for p in reversed(chain):
            depth[p] = depth[_above(p, long)] + 1
    return depth


def _open_below(base: str, depth: dict[str, int], held: set[str], long: dict[str, str]) -> dict[str, bool]:
    """For ``base`` and each path below it: whether no element in between (or itself) is boilerplate."""
    open_ = {base: True}
    for path in depth:
        if path not in open_ and path:
            above = _above(path, long)
            if above in open_:
                open_[path] = open_[above] and (path in held or not _is_boilerplate(path.rsplit("/", 1)[1], bool(base)))
    return open_


def held_paths(nodes: dict[str, tuple[int, int]], long: dict[str, str]) -> set[str]:
    """Elements that hold most of the text outside links: their class words do not make them
    boilerplate, unless they mark reader comments."""
    below = Counter({path: max(0, chars - link) for path, (chars, link) in nodes.items()})
    for path in reversed(outline(nodes, long)):
        if path:
            below[_above(path, long)] += below[path]
    held = set()
    for path, chars in below.items():
        if path and 2 * chars > below[""]:
            tag, *words = path.rsplit("/", 1)[1].split(".")
            if not _by_tag(tag, False) and not any(_marks(w, False) & COMMENT_WORDS for w in words):
                held.add(path)
    return held


def tags(page: str) -> Iterator[tuple[str, str, str]]:
    """(text, "", "") for text, ("/" or "", tag, attributes) for tags; comments, declarations
    and ``SKIPPED`` elements are left out, and what they hold with them.

    Time is linear in the page, however broken: no search that has failed is tried again.
    A comment or skipped element without end takes the rest.  A ``<`` that opens nothing, or
    with no ``>`` after it, is text.  Once quotes leave a tag without an end, quotes no longer
    hide a ``>`` on the rest of the page."""
    at, size, last, pattern = 0, len(page), page.rfind(">"), _TAG
    while at < size:
        lt = page.find("<", at)
        if lt < 0 or lt > last:
            if page.find("<!--", at) < 0:
                yield page[at:], "", ""
                return
            lt = page.find("<!--", at)
        if lt > at:
            yield page[at:lt], "", ""
        follows = page[lt + 1:lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = size if end < 0 else end + 3
            continue
        if follows in ("!", "?"):
            at = page.find(">", lt) + 1
            continue
        m = pattern.match(page, lt)
        if m is None and (follows.isascii() and follows.isalpha() or follows == "/" and re.match("[a-zA-Z]", page[lt + 2:lt + 3])):
            pattern = _TAG_PLAIN
            m = pattern.match(page, lt)
        if m is None:
            yield "<", "", ""
            at = lt + 1
            continue
        closing, tag = m.group(1), m.group(2).lower()
        at = m.end()
        if tag in SKIPPED:
            if not closing:
                end = _END[tag].search(page, at)
                at = end.end() if end else size
            continue
        yield closing, tag, m.group(3)


def parse(page: str) -> tuple[Counter, list[tuple[str, str, int]], dict[str, str]]:
    """(occurrences of each structural token by its path, blocks of (path, text, link characters),
    the path above each path beyond ``PATH_CHARS``); linear in the page and its nesting."""
    tokens: Counter = Counter()
    blocks: list[tuple[str, str, int]] = []
    long: dict[str, str] = {}
    stack: list[tuple[str, str]] = []  # (tag, path)
    depths: dict[str, list[int]] = defaultdict(list)  # where on the stack each tag is, ascending
    run: list[str] = []
    links = in_link = 0

    def flush() -> None:
        nonlocal links
        if run:
            text = " ".join(htmllib.unescape("".join(run)).split())
            if text:
                blocks.append((stack[-1][1] if stack else "", text, links))
            run.clear()
        links = 0

    def deepest(names: set[str]) -> int:
        return max((depths[t][-1] for t in names if depths[t]), default=-1)

    def close(names: set[str], stop: set[str] = frozenset()) -> None:
        at = deepest(names)
        if at >= 0 and at > deepest(stop):
            while len(stack) > at:
                depths[stack.pop()[0]].pop()

    for closing, tag, attributes in tags(page):
        if not tag:
            run.append(closing)
            links += len(closing) if in_link else 0
            continue
        if tag == "a":
            in_link = 0 if closing else 1
        elif tag == "br":
            run.append(" ")
        if tag not in STRUCTURE:
            continue
        flush()
        if closing:
            close({tag})
            continue
        if tag in CLOSES_P:
            close({"p"}, P_LIMITS)
        if tag in CLOSES_SAME:
            close(CLOSES_SAME[tag], LIST_LIMITS)
        if tag in ("html", "body", "head") and depths[tag]:
            continue
        if tag == "body":
            close({"head"})
        above, name = stack[-1][1] if stack else "", _name(tag, attributes)
        path = f"{above}/{name}"
        if len(path) > PATH_CHARS and above:
            path = f"/#{hashlib.blake2b(above.encode('utf-8', 'replace'), digest_size=12).hexdigest()}/{name}"
            long[path] = above
        tokens[path] += 1
        if tag not in VOID:
            depths[tag].append(len(stack))
            stack.append((tag, path))
    flush()
    return tokens, blocks, long


def choose_main(template: set[str], nodes: dict[str, tuple[int, int]], held: set[str], long: dict[str, str]) -> tuple[str, int]:
    """(path, text) of the template element whose slots hold the main text: an ``article`` or
    ``main`` of the template, or else the deepest element that keeps ``MIN_MASS`` of the
    text outside boilerplate.  An element's text is what lies below it outside
    boilerplate, links counted against it: one pass from the leaves up.  ("", 0):
    the page as a whole, where no element holds so much of it."""
    depth = outline([*nodes, *template], long)
    open_ = _open_below("", depth, held, long)
    mass = {path: nodes[path][0] - 2 * nodes[path][1] if path in nodes else 0 for path in depth}
    for path in reversed(depth):
        if path and (path in held or not _is_boilerplate(path.rsplit("/", 1)[1], True)):
            mass[_above(path, long)] += mass[path]
    names = {p: p.rsplit("/", 1)[1] for p in template if p and open_[p]}
    named = [p for p, name in names.items() if name.split(".")[0] in MAIN_TAGS or ".main" in name]
    masses = {p: mass[p] for p in (named or names)}
    if not masses or not named and max(masses.values()) < MIN_MASS * mass[""]:
        return "", 0
    most = max(masses.values())
    good = {p for p, v in masses.items() if v >= MIN_MASS * most} or set(masses)
    if named:
        below = set()  # elements below a good one
        for path in depth:
            if path and (_above(path, long) in below or _above(path, long) in good):
                below.add(path)
        main = min((p for p in good if p not in below), key=lambda p: (-masses[p], p))
    else:
        wrap = [p for p in good if names[p].split(".")[0] not in {"p", "li"} | HEADINGS]
        if not wrap:
            return "", 0
        main = max(wrap, key=lambda p: (depth[p], masses[p], p))
    return main, masses[main]


def text_token(path: str, text: str) -> str:
    """Token of a block of text: a leaf below the path of its element."""
    return f"{path}/~{hashlib.blake2b(text.encode('utf-8', 'replace'), digest_size=12).hexdigest()}"


def main_text(page: str, main: str | None, held: set[str] = frozenset(), repeated: set[str] = frozenset()) -> str:
    """Blocks below the template's main element, outside boilerplate; a page without that
    element is judged on its own tokens.  ``held``: the host's elements that hold most text;
    ``repeated``: its text tokens that are part of the template."""
    tokens, blocks, long = parse(page)
    depth = outline(tokens, long)
    if not main or main not in tokens:
        sums: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for path, text, link in blocks:
            sums[path][0] += len(text)
            sums[path][1] += link
        nodes = {p: tuple(v) for p, v in sums.items()}
        held = held_paths(nodes, long)
        main = choose_main(set(tokens), nodes, held, long)[0]
    open_ = _open_below(main, depth, held, long)
    return "\n\n".join(t for p, t, _ in blocks if open_.get(p) and not (repeated and text_token(p, t) in repeated))


def token_vectors(pages: DataFrame, texts: bool = False) -> DataFrame:
    """Per (host, token): pages it is on, occurrences, text and link characters directly
    below it, and two checksums of its occurrence vector (sum over pages of a hash of
    page and count), so tokens with equal vectors have equal checksums.  ``texts``: blocks
    of text count as tokens too, named by a hash.

    A task adds up the pages it has read, so a host with a third of all pages is a few
    rows per task before the shuffle."""
    schema = pa.schema([("host", pa.string()), ("token", pa.string()), ("above", pa.string()), *[(c, pa.int64()) for c in (
        "pages", "occurrences", "chars", "links", "v1", "v2")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            sums: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0] * 6)
            above: dict[str, str] = {}
            for page_id, host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_of(batch, "html").to_pylist()):
                tokens, blocks, long = parse(page)
                above.update(long)
                tokens[""] = 1  # the page itself: counts the pages of the host
                if texts:
                    for path, text, _ in blocks:
                        tokens[text_token(path, text)] += 1
                        sums[host, text_token(path, text)][2] += len(text)
                for token, n in tokens.items():
                    s = sums[host, token]
                    h = xxhash.xxh64_intdigest(f"{page_id}|{n}")
                    for i, x in enumerate((1, n, 0, 0, h & 0x7FFFFFFF, h >> 33)):
                        s[i] += x
                for path, text, link in blocks:
                    s = sums[host, path]
                    s[2] += len(text)
                    s[3] += link
            keys = list(sums)
            yield out_batch(schema, host=[k[0] for k in keys], token=[k[1] for k in keys], above=[above.get(k[1]) for k in keys], **{
                c: [sums[k][i] for k in keys] for i, c in enumerate(("pages", "occurrences", "chars", "links", "v1", "v2"))})

    local = pages.select("page_id", "host", "html").mapInArrow(
        run, "host string, token string, above string, pages long, occurrences long, chars long, links long, v1 long, v2 long")
    return local.groupBy("host", "token", "above").agg(*[F.sum(c).alias(c) for c in ("pages", "occurrences", "chars", "links", "v1", "v2")])


def equivalence_classes(vectors: DataFrame, host_pages: DataFrame | None = None) -> DataFrame:
    """(host, host_pages, pages, tokens): the valid classes of each host, tokens grouped by
    equal occurrence vectors.  A class is valid when its tokens reach ``VALID_SHARE`` of
    the host's pages; ``tokens`` is then bounded by the size of a page.  The first class
    (one occurrence on every page) is the template; a class nests in the class that
    holds the longest prefix of its tokens' paths.  ``host_pages``: (host, host_pages) where
    known without the vectors, so that pages are not parsed again for it."""
    host = host_pages if host_pages is not None else vectors.filter(F.col("token") == "").select("host", F.col("pages").alias("host_pages"))
    return (vectors.join(host, "host").filter(F.col("pages") >= F.ceil(F.col("host_pages") * VALID_SHARE))
            .groupBy("host", "host_pages", "pages", "occurrences", "v1", "v2")
            .agg(F.collect_list(F.struct("token", "above", "chars", "links")).alias("tokens")))


def nest(classes: list[tuple[int, list[str]]], long: dict[str, str] | None = None) -> list[int]:
    """Parent of each class (-1: none), given (pages, token paths) per class: the class of the
    nearest token above the outermost path of the class, which is on at least as many pages."""
    long = long or {}
    depth = outline([t for _, tokens in classes for t in tokens], long)
    owner = {t: i for i, (_, tokens) in enumerate(classes) for t in tokens}
    nearest: dict[str, int] = {}  # class of the path itself, or else of the nearest path above it
    for path in depth:
        nearest[path] = owner.get(path, nearest[_above(path, long)] if path else -1)
    first = [min(tokens, key=lambda t: (depth[t], t)) for _, tokens in classes]
    return [nearest[_above(path, long)] if path else -1 for path in first]


def template_text(recurring: dict[str, int], nodes: dict[str, tuple[int, int]], main: str, long: dict[str, str]) -> list[str]:
    """The text tokens of ``recurring`` (with their characters) inside an element of ``BOXES``
    below ``main`` that has no other text; one pass up, one down."""
    depth = outline([*nodes, *recurring], long)
    chars, known = Counter({p: n for p, (n, _) in nodes.items()}), Counter(recurring)
    for path in reversed(depth):
        if path:
            above = _above(path, long)
            chars[above] += chars[path]
            known[above] += known[path]
    below, full = {main}, set()
    for path in depth:
        above = _above(path, long) if path else path
        if path and path != main and above in below:
            below.add(path)
            if above in full or path.rsplit("/", 1)[1].split(".")[0] in BOXES and 0 < chars[path] == known[path]:
                full.add(path)
    return sorted(full & recurring.keys())


def host_templates(pages: DataFrame) -> DataFrame:
    """(host, main, held, repeated): per host the template element that holds the main slots,
    the elements below it that hold most of the host's text whatever their class, and the
    text tokens below it that are template text.  The classes of a host are nested and the
    choice runs over the elements reached from the root class, outermost first.

    Template text has the root class's occurrence vector, once on every page of at least
    ``MIN_PAGES``, and fills a whole element of ``BOXES``: a paragraph, heading or list of the
    article that repeats is no notice.  Where half of the main text or more recurs, the pages
    are copies of one another and all stays."""
    classes = equivalence_classes(token_vectors(pages, texts=True), pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")))
    per_host = classes.groupBy("host", "host_pages").agg(F.collect_list(F.struct("pages", "occurrences", "tokens")).alias("classes"))
    schema = pa.schema([("host", pa.string()), ("main", pa.string()), ("held", pa.list_(pa.string())),
                        ("repeated", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                text = {t["token"]: t["chars"] for c in row["classes"] for t in c["tokens"] if "/~" in t["token"]}
                own = [(c["pages"], [t["token"] for t in c["tokens"]]) for c in row["classes"]]
                long = {t["token"]: t["above"] for c in row["classes"] for t in c["tokens"] if t["above"] is not None}
                parents = nest(own, long)
                nodes = {t["token"]: (t["chars"], t["links"]) for c in row["classes"] for t in c["tokens"] if t["token"] not in text}
                root = {t for i, c in enumerate(row["classes"]) if c["pages"] == c["occurrences"] == row["host_pages"]
                        for t in own[i][1]}
                nested = {t for i, (_, tokens) in enumerate(own) if parents[i] >= 0 or not root.isdisjoint(tokens) for t in tokens}
                held = held_paths(nodes, long)
                main, mass = choose_main(root - {""} - text.keys(), nodes, held, long)
                if not main or mass <= 0:
                    main, mass = choose_main(nested - {""} - text.keys(), nodes, held, long)
                inside = _open_below(main, outline([*nodes, *text], long), held, long) if main else {}
                held = sorted(p for p in held if p != main and p in inside and _is_boilerplate(p.rsplit("/", 1)[1], True))
                recurring = {t: text[t] for t in root & text.keys() if inside.get(t)}
                copies = 2 * sum(recurring.values()) >= mass
                repeated = [] if copies or row["host_pages"] < MIN_PAGES else template_text(recurring, nodes, main, long)
                found.append((row["host"], main, held, repeated))
            yield out_batch(schema, **{f.name: [x[i] for x in found] for i, f in enumerate(schema)})

    return per_host.mapInArrow(run, "host string, main string, held array<string>, repeated array<string>")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Tokens are structural tags with their path and class, and blocks of text.  Occurrence vectors and classes per host give the
    template, its main element gives the slots, and the text of the page in these slots
    is the result, less notices that every page of the host has there: blocks in page order, character references decoded, white space as
    one space, joined by two line feeds.  Pages are parsed where they are read; per host
    only token sums are shuffled.  The chosen elements come back by broadcast below
    ``BROADCAST_BYTES`` (measured), by a join on the host beyond.

    NULL or empty html gives an empty text.  Pages with a NULL or odd url share the empty
    host.  A page without the host's main element is judged on its own tokens.  Repeated
    rows repeat; an empty table gives no rows; other columns are ignored.  Broken and deeply
    nested pages cost time and memory in proportion to their length (``tags``, ``parse``).
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), "html")
    found = checkpointed(host_templates(slim))
    size = found.agg(F.sum(F.octet_length("host") + F.octet_length("main")
                             + F.octet_length(F.array_join("held", "")) + F.octet_length(F.array_join("repeated", "")) + 64)).first()[0] or 0
    found = found.withColumnRenamed("host", "_host")
    joined = slim.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, F.col("host") == F.col("_host"), "left")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            texts = [main_text(p, m, frozenset(h or ()), frozenset(r or ())) for p, m, h, r in zip(
                text_of(batch, "html").to_pylist(), *(batch.column(i).to_pylist() for i in (3, 4, 5)))]
            yield out_batch(schema, page_id=batch.column(0), url=batch.column(1), text=texts, n_chars=[len(t) for t in texts])

    return joined.select("page_id", "url", "html", "main", "held", "repeated").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
