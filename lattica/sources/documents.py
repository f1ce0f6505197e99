"""Small documents: YAML, JSON, event logs, HTML tables, sheets, header dumps, partition templates."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Sequence
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.constraints import GateError


def yaml_mapping(path: str) -> dict:
    """A configuration, which must be a mapping; it is read in the driver."""
    import yaml

    with open(path, encoding="utf-8") as f:
        got = yaml.safe_load(f)
    if not isinstance(got, dict):
        raise GateError(f"{path} is no mapping")
    return got


def registry_frame(spark: SparkSession, registry: dict[str, dict[str, str]]) -> DataFrame:
    """kind, source_key, canonical_id of a nested registry."""
    rows = [(kind, key, value) for kind, keys in sorted(registry.items()) for key, value in sorted(keys.items())]
    return spark.createDataFrame(rows, "kind string, source_key string, canonical_id string")


def json_document(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def latest_events(spark: SparkSession, path: str, result: str = "acquired", key: str = "artifact_id", at: str = "retrieved_at") -> DataFrame:
    """Latest time of each artifact in an event log of JSON lines; blank lines and other results are left out."""
    log = spark.read.schema(f"{key} string, result string, {at} string").json(path)
    return log.where(F.col("result") == result).groupBy(key).agg(F.max(at).alias(at))


def fixture_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def html_cells(df: DataFrame, html_col: str, code: str = r"\d{5}") -> DataFrame:
    """code, name, token of a table's rows ``<th data-unique="code">name</th><td>token</td>``."""
    whole = rf'<th[^>]*data-unique="({code})"[^>]*>([^<]*)</th>\s*<td[^>]*>([^<]*)</td>'
    part = lambda i: F.regexp_extract_all(html_col, F.lit(whole), F.lit(i))
    rows = F.arrays_zip(part(1).alias("code"), part(2).alias("name"), part(3).alias("token"))
    return df.select(F.explode(rows).alias("r")).select("r.code", "r.name", "r.token")


def xlsx_rows(path: str, sheet: int = 1) -> list[tuple[int, dict[int, object]]]:
    """(row number, {column number: value}) of a sheet; numbers are numbers, the rest text.

    A workbook is a small file: it is read in the driver, without further libraries.
    """
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        root = ElementTree.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml"))
    out = []
    for row in root.iter(f"{{{ns['m']}}}row"):
        cells: dict[int, object] = {}
        for c in row.findall("m:c", ns):
            letters = re.match(r"[A-Z]+", c.get("r", "A"))[0]
            column = 0
            for ch in letters:
                column = column * 26 + ord(ch) - 64
            v, kind = c.find("m:v", ns), c.get("t")
            if kind == "inlineStr":
                cells[column] = "".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t"))
            elif v is not None:
                cells[column] = shared[int(v.text)] if kind == "s" else v.text if kind == "str" else float(v.text)
        out.append((int(row.get("r")), cells))
    return out


def district_sheet(spark: SparkSession, path: str, columns: dict[str, int], headers: dict[tuple[int, int], str]) -> DataFrame:
    """row_number and the named columns (strings) of a sheet whose header cells must be as given."""
    rows = xlsx_rows(path)
    cells = {(n, c): v for n, row in rows for c, v in row.items()}
    wrong = {at: cells.get(at) for at, want in headers.items() if cells.get(at) != want}
    if wrong:
        raise GateError(f"header cells differ: {wrong}")
    text = lambda v: None if v is None else str(int(v)) if isinstance(v, float) and v == int(v) else str(v)
    first = max((n for n, _ in headers), default=0)
    data = [(n, *(text(row.get(c)) for c in columns.values())) for n, row in rows if n > first]
    return spark.createDataFrame(data, "row_number int, " + ", ".join(f"`{c}` string" for c in columns))


def leaves(df: DataFrame, leaf: str, code: str, prefixes: Sequence[str], width: int = 2) -> DataFrame:
    """Leaf rows of the wanted prefectures; subtotal rows go."""
    return df.where(F.col(leaf).isNotNull() & F.substring(F.col(code), 1, width).isin(*prefixes))


def header_dump(text: str) -> dict:
    """The last response of a dump of HTTP headers, with the chain before it; repeated headers become lists."""
    chain: list[dict] = []
    for line in text.splitlines():
        if line.startswith("HTTP/"):
            words = line.split(None, 2)
            chain.append({"status_line": line, "status": int(words[1]) if len(words) > 1 and words[1].isdigit() else None, "headers": {}})
        elif chain and ":" in line:
            name, value = (x.strip() for x in line.split(":", 1))
            chain[-1]["headers"].setdefault(name.lower(), []).append(value)
    if not chain:
        raise ValueError("no HTTP response")
    final = {k: v[0] if len(v) == 1 else v for k, v in chain[-1]["headers"].items()}
    length = final.get("content-length")
    return {
        "chain": [{k: r[k] for k in ("status_line", "status")} for r in chain],
        "status": chain[-1]["status"],
        "headers": final,
        "content_length": int(length) if isinstance(length, str) and length.isdigit() else None,
    }


def expand_template(spark: SparkSession, specs: Sequence[dict]) -> DataFrame:
    """Artifacts of specs with partition codes: ``{code}`` in id and url replaced by each code of two digits.

    Repeated ids, or no artifact at all, fail.
    """
    rows = spark.createDataFrame([(s["artifact_id"], s["url"], s.get("codes")) for s in specs], "artifact_id string, url string, codes array<int>")
    rows = rows.select("artifact_id", "url", F.explode_outer("codes").alias("c")).withColumn("code", F.lpad(F.col("c").cast("string"), 2, "0"))
    put = lambda c: F.coalesce(F.replace(F.col(c), F.lit("{code}"), F.col("code")), F.col(c)).alias(c)
    out = rows.select(put("artifact_id"), put("url"), "code")
    again = [r["artifact_id"] for r in out.groupBy("artifact_id").count().where("count > 1").collect()]
    if again:
        raise GateError(f"repeated artifacts: {again}")
    if out.isEmpty():
        raise GateError("no artifacts")
    return out


def wanted_meshes(path_df: DataFrame, mesh: str, wanted: DataFrame, most: int = 10_000) -> DataFrame:
    """Rows of the wanted cells only.

    Up to ``most`` cells are a list in the plan, which reaches the Parquet scan
    and passes over row groups without any of them; more are joined.
    """
    cells = wanted.where(F.col(mesh).isNotNull()).select(mesh).distinct()
    few = [r[0] for r in cells.limit(most + 1).collect()]
    return path_df.where(F.col(mesh).isin(*few)) if len(few) <= most else path_df.join(cells, mesh, "left_semi")
