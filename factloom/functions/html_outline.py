"""Elements of a page from its tags alone, as native expressions.

A page without comments and hidden elements is cut into tokens, tags and texts, and its
tags are folded once over a stack of open elements.  End tags close up to the element they
name, or nothing; some start tags close elements that HTML lets end by themselves.  The
stack is as deep as the page nests, and results grow only where something is found, so the
work follows the number of tags.  Rules are those of the tree reader in ``html_tree``,
whose sets are used here.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .html import decode_entities, has_foreign_entity, is_torn
from .html_tree import CLOSES, SCOPES, VOID

TOKENS = r"(?s)<(?:/?[a-zA-Z]|[!?])[^>]*>|[^<\x00]+|<"
NAME = r"^<(/?[a-zA-Z][^\s/>]*)"
_ATTRIBUTE = r"""\s++(?!href[\s=>/])[^\s=>/"']++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?+"""
HREF = rf"""(?is)^<a(?:{_ATTRIBUTE}|\s*+/)*+\s++href\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))"""
_START = """named_struct('stack', cast(array() AS array<struct<name:string,at:int,hot:boolean>>),
 'boxes', cast(array() AS array<struct<at:int,last:int>>), 'anchors', cast(array() AS array<struct<at:int,parent:int>>))"""


def _names(values) -> str:
    return ", ".join(f"'{v}'" for v in sorted(values))


def _closed_by() -> str:
    """Whether the start tag ``t`` closes the open element ``e``."""
    same: dict[tuple, list[str]] = {}
    for tag, closed in CLOSES.items():
        same.setdefault(tuple(sorted(closed)), []).append(tag)
    cases = " ".join(f"WHEN t.name IN ({_names(tags)}) THEN e.name IN ({_names(closed)})" for closed, tags in same.items())
    return f"CASE {cases} ELSE false END"


def _cut(stack: str, keep: str) -> str:
    """State ``s`` after all but the first ``keep`` open elements end at the tag ``t``."""
    gone = f"filter(slice({stack}, {keep} + 1, size({stack})), e -> e.hot)"
    return f"""named_struct('stack', slice({stack}, 1, {keep}), 'boxes', if(exists(slice({stack}, {keep} + 1, size({stack})), e -> e.hot),
 concat(s.boxes, transform({gone}, e -> named_struct('at', e.at, 'last', t.at))), s.boxes), 'anchors', s.anchors)"""


def _step() -> str:
    let = lambda name, value, body: f"transform(array({value}), {name} -> {body})[0]"
    place = "array_position(reverse(transform(s.stack, e -> e.name)), substring(t.name, 2))"
    end = let("p", place, f"if(p = 0, s, {_cut('s.stack', 'cast(size(s.stack) - p AS int)')})")
    scope = f"coalesce(array_max(transform(s.stack, (e, i) -> if(e.name IN ({_names(SCOPES)}), i, -1))), -1)"
    first = f"coalesce(array_min(transform(s.stack, (e, i) -> if(i > scope AND {_closed_by()}, i, null))), size(s.stack))"
    closing = let("scope", scope, let("keep", first, f"if(keep = size(s.stack), s, {_cut('s.stack', 'keep')})"))
    closed = f"if(t.name IN ({_names(CLOSES)}), {closing}, s)"
    depth = "size(o.stack)"
    marked = f"""if(t.link AND {depth} > 0, concat(slice(o.stack, 1, {depth} - 1),
 array(named_struct('name', o.stack[{depth} - 1].name, 'at', o.stack[{depth} - 1].at, 'hot', true))), o.stack)"""
    parent = f"if({depth} > 0, get(o.stack, {depth} - 1).at, -1)"
    opened = f"""named_struct('stack', if(t.leaf, {marked}, concat({marked}, array(named_struct('name', t.name, 'at', t.at, 'hot', false)))),
 'boxes', o.boxes, 'anchors', if(t.link, concat(o.anchors, array(named_struct('at', t.at, 'parent', {parent}))), o.anchors))"""
    return f"if(startswith(t.name, '/'), {end}, {let('o', closed, opened)})"


def tokens(page: Column) -> Column:
    """Tags and texts of ``visible`` markup, in order."""
    return F.regexp_extract_all(page, F.lit(TOKENS), 0)


def outline(parts: Column) -> Column:
    """``anchors`` with an address (token, token of the parent or -1), and ``boxes``, where
    their parents begin and end; a parent left open ends with the page."""
    named = F.transform(parts, lambda t, i: F.struct(
        i.alias("at"), F.lower(F.regexp_extract(t, NAME, 1)).alias("name"), t.rlike(HREF).alias("link")))
    # Void elements and those that end at the next tag stay off the stack; of these only
    # anchors and such as close others count.
    tags = F.expr(f"""t -> transform(array(filter(t, e -> e.name <> '')), n -> filter(
 transform(n, (e, i) -> named_struct('at', e.at, 'name', e.name, 'link', e.link,
  'leaf', e.name IN ({_names(VOID)}) OR coalesce(get(n, i + 1).name = concat('/', e.name), false))),
 (e, i) -> if(startswith(e.name, '/'), i = 0 OR get(n, i - 1).name <> substring(e.name, 2), e.link OR NOT e.leaf OR e.name IN ({_names(CLOSES)}))))[0]""")
    tags = F.get(F.call_function("transform", F.array(named), tags), F.lit(0))
    # Built as SQL text: one expression for the driver, however deep.
    folded = F.call_function("aggregate", tags, F.expr(_START), F.expr(f"(s, t) -> {_step()}"))
    def rest(state: Column) -> Column:
        left = F.transform(F.filter(state["stack"], lambda e: e["hot"]), lambda e: F.struct(e["at"].alias("at"), F.size(parts).alias("last")))
        above = F.exists(state["anchors"], lambda a: a["parent"] < 0)
        root = F.filter(F.array(F.struct(F.lit(-1).alias("at"), F.size(parts).alias("last"))), lambda b: above)
        return F.struct(state["anchors"].alias("anchors"), F.concat(state["boxes"], left, root).alias("boxes"))
    return F.get(F.transform(F.array(folded), rest), F.lit(0))


def parent_dates(parts: Column, found: Column, date_pattern: str) -> Column:
    """Token of each parent of an anchor -> the first date in its text."""
    def date(box: Column) -> Column:
        inside = F.slice(parts, box["at"] + 2, F.greatest(box["last"] - box["at"] - 1, F.lit(0)))
        text = F.array_join(F.filter(inside, lambda t: ~t.rlike(r"^<[a-zA-Z/!?]")), " ")
        return F.regexp_extract(decode_entities(text), date_pattern, 0)

    return F.map_from_entries(F.transform(found["boxes"], lambda b: F.struct(b["at"], date(b))))


def dated_anchors(parts: Column, found: Column, dates: Column) -> Column:
    """Address of every anchor, and the date of its direct parent.  ``dates`` is bound
    before: what a lambda holds is computed again for each element."""
    def anchor(a: Column, bound: Column) -> Column:
        tag = F.get(parts, a["at"])
        href = decode_entities(F.concat(*[F.regexp_extract(tag, HREF, i) for i in (1, 2, 3)]), attribute=True)
        return F.struct(href.alias("href"), F.try_element_at(bound, a["parent"]).alias("date"))

    every = F.transform(F.array(F.struct(dates.alias("dates"), found["anchors"].alias("anchors"))), lambda x: F.transform(x["anchors"], lambda a: anchor(a, x["dates"])))
    return F.get(every, F.lit(0))


def is_hard(html: Column, page: Column, parts: Column) -> Column:
    """Pages whose anchors the fold could read otherwise than the tree reader: torn markup,
    tags inside elements that hold none, unclear addresses, a slash written as its name."""
    unread = F.exists(parts, lambda t: t.rlike(r"(?is)^<a[\s/].*href") & (~t.rlike(HREF) | has_foreign_entity(t)))
    inside = html.rlike(r"(?is)<(template|rt|rp|textarea|title)[\s/>](?:(?!</\1).)*?<(?!/\1)")
    return unread | is_torn(page) | inside | page.contains("&sol")
