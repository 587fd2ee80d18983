"""Anchors and table rows of HTML pages in one linear scan.

Each page is read once from left to right: the next ``<`` is searched for, the
tag, comment or raw text (script, style) that begins there is taken whole, and a
small state (open anchor, depth of tables, open row and cell) is carried on. No
pattern backtracks, so a page costs time in proportion to its length, whatever
it holds: tags of any length, unclosed anchors, tables in cells. Tags, cells and
links in their plainest form, which most pages are made of, are taken by one match each.

The scan is an Arrow function over batches of pages, as its state can't be
expressed by column functions; it returns nested columns, and what follows
(lookups, filters, URLs) is plain column work. It is made by ``_scanner`` so
that it travels to the workers whole, without this package being there.

Markup is read as browsers do: a new anchor, cell or row closes the one before,
names fold case, attribute values may be quoted in any way, an unclosed comment
or script hides the rest of the page, an unclosed tag at the end is no tag.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

ANCHORS = ArrayType(StructType([StructField("href", StringType()), StructField("text", StringType())]))
ROWS = ArrayType(StructType([
    StructField("pos", IntegerType()),
    StructField("cells", ArrayType(StructType([StructField("text", StringType()), StructField("pieces", StringType())]))),
    StructField("href", StringType())]))


def _scanner():
    """``(anchors of a page, rows of a page)`` as plain functions."""
    import re
    from html.entities import html5

    raw_text = {"script", "style", "textarea", "title"}
    name_of = re.compile(r"/?[A-Za-z][^\s/>]*")
    # one attribute; a quote that is never closed is part of a bare value
    attribute = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*|=)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
    blank = re.compile(r"[\s/]*")
    # the plainest forms, which the general steps below would read alike: a tag with double-quoted attributes, cells of text, a cell of one link, a row of such cells with one link
    plain_tag = re.compile(r"""<(/?[A-Za-z][^\s/>"']*)(?:\s+[^\s/>="']+="[^"]*")*\s*>""")
    plain_cells = re.compile(r"(?:<td>[^<]*</td>)+")
    plain_link = re.compile(r'<td><a href="([^"<>]*)">([^<]*)</a></td>')
    plain_row = re.compile(r'<tr>((?:<td>[^<]*</td>)*)<td><a href="([^"<>]*)">([^<]*)</a></td>((?:<td>[^<]*</td>)*)</tr>')
    ends = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in raw_text}
    entity = re.compile(r"&(?:#([0-9]{1,7})|#[xX]([0-9a-fA-F]{1,6})|([A-Za-z][A-Za-z0-9]{1,31}));")

    def decoded(m):
        decimal, hexadecimal, name = m.groups()
        if name:
            return html5.get(name + ";", m[0])
        code = int(decimal) if decimal else int(hexadecimal, 16)
        return chr(code) if 0 < code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else m[0]

    def unescaped(text):
        return entity.sub(decoded, text) if "&" in text else text

    def tag_end(html, at):
        """The place after the tag whose name ends at ``at``, or -1 for a tag that has no end."""
        end = html.find(">", at)
        if end < 0:
            return -1
        inside = html[at:end]
        if '"' not in inside and "'" not in inside:
            return end + 1
        while True:
            at = blank.match(html, at).end()
            if at >= len(html):
                return -1
            if html[at] == ">":
                return at + 1
            at = attribute.match(html, at).end()

    def value(html, at, end, wanted):
        """The decoded value of the tag's first attribute of that name; None without one."""
        while True:
            m = attribute.match(html, at, end)
            if not m:
                return None
            if m[1].lower() == wanted:
                v = m[2] or ""
                return unescaped(v[1:-1] if len(v) > 1 and v[0] in "\"'" and v[-1] == v[0] else v).strip()
            at = m.end()

    def tokens(html, cells=False):
        """``(name, text, start, end)``: texts have the name None; tags ``a``, ``/a``, ... and where their attributes are.

        With ``cells``, a run of plain cells is one token ``cells``, a plain cell of one link a token ``link`` (text, href),
        and a plain row of them a token ``row`` (the groups of ``plain_row``).
        """
        at, size = 0, len(html)
        while at < size:
            start = html.find("<", at)
            if start < 0:
                yield None, html[at:], 0, 0
                return
            if start > at:
                yield None, html[at:start], 0, 0
            if cells and html.startswith("<tr><td>", start):
                m = plain_row.match(html, start)
                if m:
                    yield "row", m.groups(), 0, 0
                    at = m.end()
                    continue
            if cells and html.startswith("<td>", start):
                m = plain_cells.match(html, start)
                if m:
                    yield "cells", m[0], 0, 0
                    at = m.end()
                    continue
                m = plain_link.match(html, start)
                if m:
                    yield "link", m[2], m[1], 0
                    at = m.end()
                    continue
            m = plain_tag.match(html, start)
            if m:
                name = m[1].lower()
                if name not in raw_text:
                    yield name, "", m.end(1), m.end() - 1
                    at = m.end()
                    continue
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                if end < 0:
                    return
                at = end + 3
                continue
            if html.startswith(("<!", "<?"), start):
                end = html.find(">", start)
                if end < 0:
                    return
                at = end + 1
                continue
            m = name_of.match(html, start + 1)
            if not m:
                yield None, "<", 0, 0
                at = start + 1
                continue
            end = tag_end(html, m.end())
            if end < 0:
                return
            name = m[0].lower()
            yield name, "", m.end(), end - 1
            at = end
            if name in raw_text:
                close = ends[name].search(html, at)
                if not close:
                    return
                if name in ("textarea", "title"):
                    yield None, html[at:close.start()], 0, 0
                at = close.start()

    def anchors(html):
        found, open_ = [], None
        for name, text, start, end in tokens(html):
            if name is None:
                if open_ is not None:
                    open_[1].append(text)
            elif name == "a" or name == "/a":
                if open_ is not None:
                    found.append(open_)
                open_ = (value(html, start, end, "href"), []) if name == "a" else None
        if open_ is not None:
            found.append(open_)
        return [{"href": href, "text": unescaped("".join(pieces)).strip()} for href, pieces in found]

    def row_cells(html):
        """Rows of the first table's first body, without those of tables in its cells, as ``(texts, pieces, href)``; the href is that of
        the second cell's first link."""
        out, depth, body, row, cell, href = [], 0, False, None, None, None

        def split(run):
            return run[4:-5].split("</td><td>") if run else []

        def end_cell():
            nonlocal cell
            if cell is not None:
                texts = [unescaped(t) for t in cell]
                row[0].append("".join(texts).strip())
                row[1].append("".join([t.strip() for t in texts]))
                cell = None

        def end_row():
            nonlocal row, href
            end_cell()
            if row is not None:
                out.append((*row, href))
                row = href = None

        for name, text, start, end in tokens(html, True):
            if name is None:
                if cell is not None:
                    cell.append(text)
            elif name == "row":
                before, link, label, after = text
                texts = split(before)
                second = len(texts) == 1
                texts.append(label)
                texts += split(after)
                if depth == 1 and body:
                    end_row()
                    texts = [(unescaped(t) if "&" in t else t).strip() for t in texts]
                    out.append((texts, texts, unescaped(link).strip() if second else None))
                elif depth > 1 and cell is not None:
                    if href is None and len(row[0]) == 1:
                        href = unescaped(link).strip()
                    cell.extend(texts)
            elif name == "cells":
                texts = split(text)
                if depth == 1 and row is not None:
                    end_cell()
                    if "&" in text:
                        texts = [unescaped(t) for t in texts]
                    texts = [t.strip() for t in texts]
                    row[0].extend(texts)
                    row[1].extend(texts)
                elif cell is not None:      # cells of a table in a cell
                    cell.extend(texts)
            elif name == "link":
                if depth == 1 and row is not None:
                    end_cell()
                    cell = []
                if cell is not None:
                    if href is None and len(row[0]) == 1:
                        href = unescaped(start).strip()
                    cell.append(text)
                    if depth == 1:
                        end_cell()
            elif name == "table":
                depth += 1
            elif name == "/table":
                if depth == 1:
                    break
                depth -= depth > 0
            elif depth == 1:
                if name == "tbody" and not body:
                    body = True
                elif not body:
                    continue
                elif name in ("tbody", "/tbody", "thead", "tfoot"):
                    break
                elif name in ("tr", "/tr"):
                    end_row()
                    row = ([], []) if name == "tr" else None
                elif name in ("td", "/td", "th", "/th"):
                    end_cell()
                    if name == "td" and row is not None:
                        cell = []
            if name == "a" and cell is not None and len(row[0]) == 1 and href is None:
                href = value(html, start, end, "href")
        if body:
            end_row()
        return out

    def rows(html):
        return [{"pos": i, "cells": [{"text": t, "pieces": p} for t, p in zip(texts, pieces)], "href": href}
                for i, (texts, pieces, href) in enumerate(row_cells(html))]

    rows.cells = row_cells
    return anchors, rows


@cache
def _anchor_scan():
    scan = _scanner()[0]

    def run(pages):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type
        return pa.array([None if p is None else scan(p) for p in pages.to_pylist()], to_arrow_type(ANCHORS))

    return F.arrow_udf(run, ANCHORS)


@cache
def _row_scan():
    scan, result = _scanner()[1].cells, ROWS

    def run(pages):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type
        # flat columns and the places where lists begin, instead of an object for each row and cell
        of_page, pos, of_row, texts, pieces, hrefs = [], [], [0], [], [], []
        for page in pages.to_pylist():
            of_page.append(None if page is None else len(pos))
            for i, (row_texts, row_pieces, href) in enumerate([] if page is None else scan(page)):
                pos.append(i)
                texts += row_texts
                pieces += row_pieces
                hrefs.append(href)
                of_row.append(len(texts))
        of_page.append(len(pos))
        rows_type = to_arrow_type(result)
        row_type = rows_type.value_type
        cells_type = row_type.field("cells").type

        def struct(arrays, of_type):
            fields = [of_type.field(i) for i in range(of_type.num_fields)]
            return pa.StructArray.from_arrays([pa.array(a, f.type) if isinstance(a, list) else a for a, f in zip(arrays, fields)], fields=fields)
        cells = pa.ListArray.from_arrays(pa.array(of_row, pa.int32()), struct([texts, pieces], cells_type.value_type), type=cells_type)
        return pa.ListArray.from_arrays(pa.array(of_page, pa.int32()), struct([pos, cells, hrefs], row_type), type=rows_type)

    return F.arrow_udf(run, result)


def anchors(html) -> Column:
    """All anchors in order: decoded ``href`` (null without one) and whole ``text``, both stripped. A null page gives null."""
    return _anchor_scan()(F.col(html) if isinstance(html, str) else html)


def table_rows(html) -> Column:
    """Rows of the page's first table body: ``pos``, ``cells`` (``text``, and ``pieces``: every text piece stripped, then
    joined) and ``href`` of the first link in the second cell. A null page gives null."""
    return _row_scan()(F.col(html) if isinstance(html, str) else html)
