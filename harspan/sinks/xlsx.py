"""Workbooks written with the standard library: SpreadsheetML parts in a zip archive.

Rows are streamed from the executors partition by partition, so the driver holds one partition at a time. A sheet takes
at most 1,048,575 rows below its header; more is an error, as the format ends there.
"""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 1_048_575
MAX_CELL = 32_767
_BAD = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def sheet_name(name: str, used: set[str], longest: int = 31) -> str:
    """``name`` without forbidden characters, cut and numbered so that it is new among ``used``, which it joins."""
    base = re.sub(r"[\[\]:*?/\\]", "_", name).strip("_ ") or "sheet"
    found, n = base[:longest], 0
    while found.lower() in used:
        n += 1
        found = f"{base[:longest][: longest - len(f'_{n}')]}_{n}"
    used.add(found.lower())
    return found


def column_widths(df: DataFrame, least: int = 10, most: int = 60, extra: int = 2) -> DataFrame:
    """``column_name`` and ``width``: the longest line of each column with its header, within bounds; one aggregate."""

    def longest(c: str) -> Column:
        lines = F.transform(F.split(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")), "\n"), lambda x: F.length(x))
        return F.coalesce(F.max(F.array_max(lines)), F.lit(0))

    stats = df.agg(*[longest(c).alias(f"w{i}") for i, c in enumerate(df.columns)])
    told = F.array(*[F.struct(F.lit(c).alias("column_name"), F.greatest(F.col(f"w{i}"), F.lit(len(c))).alias("n")) for i, c in enumerate(df.columns)])
    flat = stats.select(F.explode(told).alias("x"))
    return flat.select("x.column_name", F.least(F.greatest(F.col("x.n") + extra, F.lit(least)), F.lit(most)).cast("int").alias("width"))


def letters(i: int) -> str:
    """The name of column ``i`` from 0: A, B, .., Z, AA, .."""
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def _cell(place: str, value: object, style: int) -> str:
    if value is None:
        value = ""
    if isinstance(value, bool) or not isinstance(value, (int, float)) or value != value or abs(value) == float("inf") or abs(value) > 10**15:
        text = escape(_BAD.sub("", str(value))[:MAX_CELL])
        return f'<c r="{place}" s="{style}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'
    return f'<c r="{place}" s="{style}"><v>{value}</v></c>'


_STYLES = f"""{_HEAD}<styleSheet xmlns="{_MAIN}"><fonts count="2"><font><sz val="11"/><name val="Arial"/></font><font><b/><sz val="11"/><color rgb="FFFFFFFF"/><name val="Arial"/></font></fonts>
<fills count="3"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill><fill><patternFill patternType="solid"><fgColor rgb="FF1F4E78"/></patternFill></fill></fills>
<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>
<cellXfs count="2"><xf fontId="0" fillId="0" applyAlignment="1"><alignment vertical="top" wrapText="1"/></xf><xf fontId="1" fillId="2" applyFont="1" applyFill="1" applyAlignment="1"><alignment vertical="center" wrapText="1"/></xf></cellXfs></styleSheet>"""


def write_workbook(path: str, sheets: Iterable[tuple[str, DataFrame]]) -> dict[str, int]:
    """Writes ``sheets`` in order, each with a frozen styled header, filters and column widths; gives rows per sheet."""
    used: set[str] = set()
    counts: dict[str, int] = {}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for n, (wanted, df) in enumerate(sheets, 1):
            name = sheet_name(wanted, used)
            widths = {r.column_name: r.width for r in column_widths(df).collect()} if df.columns else {}
            last = letters(max(len(df.columns) - 1, 0))
            with tempfile.NamedTemporaryFile("w+", encoding="utf-8", suffix=".xml") as part:
                columns = "".join(f'<col min="{i}" max="{i}" width="{widths.get(c, 10)}" customWidth="1"/>' for i, c in enumerate(df.columns, 1))
                part.write(
                    f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews>'
                    + (f"<cols>{columns}</cols>" if columns else "")
                    + "<sheetData>"
                )
                part.write('<row r="1" ht="26" customHeight="1">' + "".join(_cell(f"{letters(i)}1", c, 1) for i, c in enumerate(df.columns)) + "</row>")
                rows = 0
                for row in df.toLocalIterator(prefetchPartitions=False):
                    rows += 1
                    if rows > MAX_ROWS:
                        raise ValueError(f"sheet {name} has more rows than a workbook can hold; write it as a folder instead")
                    part.write(f'<row r="{rows + 1}">' + "".join(_cell(f"{letters(i)}{rows + 1}", v, 0) for i, v in enumerate(row)) + "</row>")
                part.write(f'</sheetData><autoFilter ref="A1:{last}{rows + 1}"/></worksheet>')
                part.flush()
                out.write(part.name, f"xl/worksheets/sheet{n}.xml")
            counts[name] = rows
        _finish(out, list(counts))
    return counts


def _finish(out: zipfile.ZipFile, names: list[str]) -> None:
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, len(names) + 1))
    out.writestr(
        "[Content_Types].xml",
        f'{_HEAD}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{parts}</Types>',
    )
    links = "http://schemas.openxmlformats.org/package/2006/relationships"
    out.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{links}"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
    sheets = "".join(f'<sheet name={quoteattr(n)} sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
    out.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>{sheets}</sheets></workbook>')
    rels = "".join(f'<Relationship Id="rId{i}" Type="{_REL}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1))
    rels += f'<Relationship Id="rId{len(names) + 1}" Type="{_REL}/styles" Target="styles.xml"/>'
    out.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{links}">{rels}</Relationships>')
    out.writestr("xl/styles.xml", _STYLES)


def csv_to_workbook(spark, csv_path: str, xlsx_path: str, sheet: str = "Sheet1") -> int:
    """A CSV file as a one-sheet workbook; gives the number of rows below the header, 0 for an empty file."""
    from ..sources.delimited import read_strings

    if Path(csv_path).is_file() and not Path(csv_path).stat().st_size:
        return 0
    counts = write_workbook(xlsx_path, [(sheet, read_strings(spark, csv_path))])
    return next(iter(counts.values()))
