"""File drops: discovery, delimited and workbook scans, archiving.

Discovery lists a folder with the ``binaryFile`` source selecting only
path/size/time (file contents are not read), keeps names matching the drop
pattern at the start of the name, and orders them by the DDMMYYYY date in
the name (``order="name"`` keeps the lexical order of the original loader).
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions import blank_to_null
from ledgerwatch.schemas import DELIMITER

#: A separator that text lines never hold, so that the CSV reader (which skips
#: each file's header and blank lines) returns whole lines.
NO_SEPARATOR = "\u0001"


def own_name() -> Column:
    """The scanned file's own name. Spark reports it as part of a URI: blanks and percent
    signs are encoded, a plus sign stands for itself."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def discover(spark: SparkSession, folder: str, pattern: str, order: str = "date") -> DataFrame:
    """S1: (path, file_name, mark, file_date, batch_no) of matching drops. The mark (name,
    size, time) tells a file from a later one of the same name."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "false")
                    .load(folder).select("path", "length", "modificationTime"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    mark = F.concat_ws("|", name, F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"))
    files = (listing.select("path", name.alias("file_name"), mark.alias("mark"))
                    .filter(F.col("file_name").rlike("^" + pattern))
                    .withColumn("file_date", F.try_to_date(F.regexp_extract("file_name", r"_([0-9]{8})", 1),
                                                           "ddMMyyyy")))
    key = [F.col("file_date"), F.col("file_name")] if order == "date" else [F.col("file_name")]
    # One row per file: ordering the listing is bounded by the number of files.
    return files.withColumn("batch_no", F.row_number().over(Window.orderBy(*key)))


def discover_empty_ok(spark: SparkSession, folder: str, pattern: str, order: str = "date") -> DataFrame:
    try:
        return discover(spark, folder, pattern, order)
    except Exception as e:  # noqa: BLE001 - an absent folder means no drops
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            schema = "path string, file_name string, mark string, file_date date, batch_no int"
            return spark.createDataFrame([], schema)
        raise


def read_delimited(spark: SparkSession, paths: list[str], columns: tuple[str, ...],
                   sep: str = DELIMITER) -> DataFrame:
    """S3: header skipped per file, fields bound by position as strings,
    quotes kept literally, blank lines skipped, a row with too few or too many
    fields fails the load whatever columns are read (each line is read whole
    and its fields counted before any is taken). ``source_file`` is the file's
    own name."""
    text = (spark.read.schema("value string").option("sep", NO_SEPARATOR).option("header", "true")
                 .option("enforceSchema", "true").option("quote", "").option("escape", "")
                 .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
                 .option("mode", "FAILFAST").option("maxCharsPerColumn", "-1").csv(paths))
    line = F.coalesce("value", F.lit(""))
    fields = F.split(line, "\\Q" + sep + "\\E", -1)
    checked = F.when(F.size(fields) == len(columns), fields).otherwise(F.raise_error(F.concat(
        F.lit(f"a row without exactly {len(columns)} fields in "), own_name(), F.lit(": "), line)))
    rows = text.select(checked.alias("_f"), own_name().alias("source_file"))
    # An empty field is NULL, as the CSV reader has it.
    return rows.select(*[blank_to_null(F.col("_f")[i]).alias(c) for i, c in enumerate(columns)], "source_file")


def write_delimited_drops(df: DataFrame, folder: str, day_col: str, prefix: str,
                          columns: tuple[str, ...], sep: str = DELIMITER) -> None:
    """Write one '<prefix>_DDMMYYYY.txt' file per day (test/demo producer).

    Spark writes one folder per day; each day's single part file is then
    renamed to the drop name. Only file metadata passes through the driver.
    """
    from ledgerwatch.plans.store import _fs
    spark = df.sparkSession
    staging = folder.rstrip("/") + "/_incoming"
    (df.select(F.date_format(day_col, "ddMMyyyy").alias("_d"), *columns)
       .repartition("_d")
       .write.mode("overwrite").partitionBy("_d")
       .option("sep", sep).option("header", "true").option("quote", "").option("escape", "")
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
       .csv(staging))
    fs, root, jvm = _fs(spark, staging)
    for st in fs.listStatus(root):
        dname = st.getPath().getName()
        if not dname.startswith("_d="):
            continue
        day = dname[3:]
        parts = [p.getPath() for p in fs.listStatus(st.getPath()) if p.getPath().getName().startswith("part-")]
        for i, part in enumerate(parts):
            suffix = "" if i == 0 else f"_{i}"
            target = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{prefix}_{day}{suffix}.txt")
            fs.rename(part, target)
    fs.delete(root, True)


def archive(spark: SparkSession, paths: list[str], archive_folder: str) -> tuple[list[str], list[str]]:
    """K7: move consumed drops to ``archive/<name>.backup`` after the load
    committed. Returns (new paths, paths whose move failed); a failed move is
    not fatal, and the load remembers that the file was consumed."""
    from ledgerwatch.plans.store import rename
    moved, failed = [], []
    for p in paths:
        name = p.rstrip("/").rsplit("/", 1)[-1]
        target = f"{archive_folder.rstrip('/')}/{name}.backup"
        try:
            done = rename(spark, p, target)
        except Exception:  # noqa: BLE001 - whatever the file system says, the other files still move
            done = False
        (moved if done else failed).append(target if done else p)
    return moved, failed


# ------------------------------------------------------------------ workbooks
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
# The number formats that the file format defines as dates or times.
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


def _cell_ref_col(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _first_sheet(z: zipfile.ZipFile, names: set[str]) -> str:
    """Part name of the workbook's first sheet, by the workbook's own order."""
    if "xl/workbook.xml" in names and "xl/_rels/workbook.xml.rels" in names:
        sheet = ET.fromstring(z.read("xl/workbook.xml")).find("m:sheets/m:sheet", _NS)
        if sheet is not None:
            wanted = sheet.get(f"{{{_NS['r']}}}id")
            for rel in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")):
                if rel.get("Id") == wanted:
                    target = rel.get("Target")
                    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    sheets = [n for n in names if re.match(r"xl/worksheets/sheet\d+\.xml$", n)]
    return min(sheets, key=lambda n: int(re.search(r"(\d+)\.xml$", n).group(1)))


def _date_styles(z: zipfile.ZipFile, names: set[str]) -> set[int]:
    """Cell styles that show a number as a date or time."""
    if "xl/styles.xml" not in names:
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    dates = set(_DATE_FORMATS)
    for f in root.iterfind("m:numFmts/m:numFmt", _NS):
        code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", f.get("formatCode", ""))
        if re.search(r"[dmyhs]", code, re.I):
            dates.add(int(f.get("numFmtId")))
    return {i for i, xf in enumerate(root.iterfind("m:cellXfs/m:xf", _NS)) if int(xf.get("numFmtId", "0")) in dates}


def _date_text(serial: str, since_1904: bool) -> str:
    """A serial day number as 'yyyy-mm-dd hh:mm:ss', to the second."""
    start = dt.datetime(1904, 1, 1) if since_1904 else dt.datetime(1899, 12, 30)
    return (start + dt.timedelta(seconds=round(float(serial) * 86400))).strftime("%Y-%m-%d %H:%M:%S")


def decode_first_sheet(content: bytes) -> list[list[str | None]]:
    """Cells of the first worksheet of an .xlsx as strings (shared strings,
    inline strings, numbers, and dates as 'yyyy-mm-dd hh:mm:ss'). A cell
    without a reference follows the one before it. Small per-file helper for
    the scan job."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            root = ET.fromstring(z.read("xl/sharedStrings.xml"))
            for si in root.findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        dates = _date_styles(z, names)
        since_1904 = False
        if "xl/workbook.xml" in names:
            pr = ET.fromstring(z.read("xl/workbook.xml")).find("m:workbookPr", _NS)
            since_1904 = pr is not None and pr.get("date1904") in ("1", "true")
        root = ET.fromstring(z.read(_first_sheet(z, names)))
    rows = []
    for row in root.iter(f"{{{_NS['m']}}}row"):
        vals: dict[int, str | None] = {}
        at = -1
        for c in row.findall("m:c", _NS):
            t = c.get("t")
            if t == "inlineStr":
                v = "".join(x.text or "" for x in c.iter(f"{{{_NS['m']}}}t"))
            else:
                node = c.find("m:v", _NS)
                v = None if node is None else node.text
                if t == "s" and v is not None:
                    v = shared[int(v)]
                elif t in (None, "n") and v is not None and int(c.get("s", "0")) in dates:
                    v = _date_text(v, since_1904)
                elif t == "d" and v is not None:
                    v = v.replace("T", " ")[:19]
            at = _cell_ref_col(c.get("r")) if c.get("r") else at + 1
            vals[at] = v
        width = max(vals) + 1 if vals else 0
        rows.append([vals.get(i) for i in range(width)])
    return rows


def read_workbooks(spark: SparkSession, paths: list[str], columns: tuple[str, ...]) -> DataFrame:
    """S2: many workbooks scanned in parallel, one file per task
    (``binaryFile`` + ``mapInPandas``). First sheet, header row skipped,
    columns bound by position as strings."""
    n = len(columns)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                          + [T.StructField("source_file", T.StringType())])

    def decode(batches):
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                name = path.rsplit("/", 1)[-1]
                for r in decode_first_sheet(bytes(content))[1:]:
                    if not any(v not in (None, "") for v in r):
                        continue
                    r = (list(r) + [None] * n)[:n]
                    out.append(r + [name])
            yield pd.DataFrame(out, columns=list(columns) + ["source_file"])

    # binaryFile already spreads files over tasks; no shuffle of contents.
    return spark.read.format("binaryFile").load(paths).mapInPandas(decode, schema)


def write_workbook(rows: list[list], header: list[str], date_columns: tuple[str, ...] = ()) -> bytes:
    """Minimal .xlsx (inline strings; ``date_columns``, given as
    'yyyy-mm-dd[ hh:mm:ss]', as date cells) for producing test drops."""
    def col(i):
        s = ""
        i += 1
        while i:
            i, r = divmod(i - 1, 26)
            s = chr(65 + r) + s
        return s

    def esc(v):
        return (str(v).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;"))

    dated = {i for i, h in enumerate(header) if h in date_columns}

    def cell(ci, ri, v):
        if ci in dated and ri > 1:
            when = dt.datetime.fromisoformat(str(v)) - dt.datetime(1899, 12, 30)
            return f'<c r="{col(ci)}{ri}" s="1"><v>{when / dt.timedelta(days=1)!r}</v></c>'
        return f'<c r="{col(ci)}{ri}" t="inlineStr"><is><t>{esc(v)}</t></is></c>'

    body = []
    for ri, r in enumerate([header] + rows, start=1):
        cells = "".join(cell(ci, ri, v) for ci, v in enumerate(r) if v is not None)
        body.append(f'<row r="{ri}">{cells}</row>')
    sheet = ('<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="%s"><sheetData>%s'
             '</sheetData></worksheet>' % (_NS["m"], "".join(body)))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>')
        z.writestr("xl/styles.xml", f'<?xml version="1.0"?><styleSheet xmlns="{_NS["m"]}"><cellXfs count="2">'
                                    '<xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    return buf.getvalue()


# A worksheet holds at most 1,048,576 rows (header included).
SHEET_MAX_ROWS = 1_048_576


def write_workbook_drops(df: DataFrame, folder: str, day_col: str, prefix: str,
                         columns: tuple[str, ...], date_columns: tuple[str, ...] = (),
                         max_rows: int = 100_000) -> None:
    """Write '<prefix>_DDMMYYYY.xlsx' workbooks per day (test/demo producer).

    A day of more than ``max_rows`` rows gets several workbooks, named with a
    letter after the date's last digit. Rows are dealt to a day's workbooks by
    hash, each workbook is written inside a task, and only one status row per
    day returns to the driver."""
    import pyarrow.fs as pafs

    root = folder.rstrip("/")
    local = root[len("file:"):] if root.startswith("file:") else root
    # Spark writes a local path as file:/..., and the folder that a cluster names for its checkpoints is such a one.
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", root):
        if not re.fullmatch(r"local(\[[^\]]*\])?", df.sparkSession.sparkContext.master):
            raise ValueError(f"{root} is a path of one machine; name a shared folder with its scheme")
    day = F.date_format(day_col, "ddMMyyyy")
    # Dealing by hash isn't even: aim at half the bound, which a sheet never exceeds then.
    aim = max(1, min(max_rows, SHEET_MAX_ROWS - 1) // 2)
    books = df.groupBy(day.alias("_day_of")).agg(F.ceil(F.count(F.lit(1)) / aim).cast("long").alias("_books"))
    dealt = (df.select(day.alias("_d"), *columns).join(books, F.col("_d") == F.col("_day_of"))
               .withColumn("_book", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_books")))
               .select("_d", "_book", *columns))

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        fs, base = pafs.FileSystem.from_uri("/" + local.lstrip("/") if local.startswith("/") else root)
        book = int(pdf["_book"].iloc[0])
        # The pattern takes one character after the digits of the date.
        suffix = "" if book == 0 else chr(96 + book) if book <= 26 else chr(0x4E00 + book)
        path = f"{base}/{prefix}_{pdf['_d'].iloc[0]}{suffix}.xlsx"
        rows = pdf[list(columns)].astype(object).where(pdf[list(columns)].notna(), None).values.tolist()
        with fs.open_output_stream(path) as out:
            out.write(write_workbook(rows, list(columns), date_columns))
        return pd.DataFrame({"file": [path], "rows": [len(rows)]})

    dealt.groupBy("_d", "_book").applyInPandas(write, "file string, rows long").collect()
