"""Files as inputs: kinds by signature, members of archives, names, page selections, and the frames that read them."""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions import text as tx

# Signatures, limits and suffixes.
SIGNATURES = (
    ("pdf", ("255044462D",)),
    ("zip_archive", ("504B0304", "504B0506", "504B0708")),
    ("jpeg", ("FFD8FF",)),
    ("tiff", ("49492A00", "4D4D002A", "49492B00", "4D4D002B")),
)
SUFFIXES = (".pdf", ".tif", ".tiff", ".jpg", ".jpeg", ".zip")
MOST_MEMBERS, MOST_MEMBER_BYTES, MOST_TOTAL_BYTES = 10_000, 2 << 30, 20 << 30


def kind(content: Column) -> Column:
    """The kind of a file by its first bytes; ``unsupported`` where none fits."""
    start = F.hex(F.substring(content, 1, 16))
    out = F.lit("unsupported")
    for name, marks in reversed(SIGNATURES):
        test = F.lit(False)
        for m in marks:
            test = test | F.startswith(start, F.lit(m))
        out = F.when(test, name).otherwise(out)
    return out


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, kind, content) of the files of a folder."""
    return spark.read.format("binaryFile").load(path).select("path", "length", kind(F.col("content")).alias("kind"), "content")


def member_name(ordinal: Column, path: Column) -> Column:
    """A safe local name for a member: ordinal, cleaned stem, and suffix."""
    stem, suffix = tx.stem_and_suffix(tx.basename(path))
    stem = F.regexp_replace(F.regexp_replace(stem, r"(?U)[^\w.-]+", "_"), r"\A[._]+|[._]+\z", "")
    return F.concat(F.format_string("%04d_", ordinal), F.when(stem == "", "member").otherwise(stem), F.when(suffix.rlike(r"\A\.[a-z0-9]{1,10}\z"), suffix).otherwise(".bin"))


def upload_name(name: Column) -> Column:
    """A safe name for an upload; null where its suffix is not supported."""
    stem, suffix = tx.stem_and_suffix(F.element_at(F.split(F.replace(name, F.lit("\\"), F.lit("/")), "/"), -1))
    stem = F.regexp_replace(F.regexp_replace(stem, r"(?U)[^\w .()-]+", "_"), r"\A[ ._]+|[ ._]+\z", "")
    return F.when(suffix.isin(*SUFFIXES), F.concat(F.when(stem == "", "document").otherwise(stem), suffix))


def page_selection(spec: Column, pages: Column) -> Column:
    """The 0-based pages of a selection such as 1,3-5, sorted; all pages for an empty one; null where nothing is left."""

    def chunk(c: Column) -> Column:
        side = F.split(c, "-", 2)
        a, b = (tx.strip(F.get(side, F.lit(n))).try_cast("int") for n in (0, 1))
        return F.when(F.contains(c, F.lit("-")), F.sequence(F.least(a, b), F.greatest(a, b), F.lit(1))).otherwise(F.array(a))

    chunks = F.filter(F.transform(F.split(spec, ","), tx.strip), lambda c: c != "")
    chosen = F.filter(F.array_sort(F.array_distinct(F.flatten(F.transform(chunks, chunk)))), lambda n: (n >= 1) & (n <= pages))
    wanted = F.when(F.size(chosen) > 0, F.transform(chosen, lambda n: n - 1))
    return F.when(F.coalesce(spec, F.lit("")) == "", F.when(pages > 0, F.sequence(F.lit(0), pages - 1))).otherwise(wanted)


def weights_name(path: Column, content: Column) -> Column:
    """The name under which converted weights are kept: their own, and what identifies them: the beginning of a name that
    is a digest already, as in a download cache, else of the digest of their content."""
    name = tx.basename(path)
    stem, _ = tx.stem_and_suffix(name)
    return F.concat(stem, F.lit("-"), F.substring(F.when(name.rlike(r"\A[0-9a-f]{40,64}\z"), name).otherwise(F.sha2(content, 256)), 1, 16), F.lit(".safetensors"))


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """The detection manifests under a document's folder."""
    schema = "page int, prepared_image string, page_size array<int>, lines array<struct<id:string,type:string,bbox:array<int>,polygon:array<array<int>>,detector_confidence:double,tile_ids:array<int>,region_id:string>>, regions array<struct<id:string,type:string,bbox:array<int>,detector_confidence:double,tile_ids:array<int>>>"
    return spark.read.schema(schema).option("multiLine", True).json(f"{root}/page_*/detections.json")


def read_json_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, v): whole JSON files as VARIANT, without a byte-order mark; null where a file is no JSON."""
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.regexp_replace("value", "\\A\ufeff", "").alias("value"))
    return rows.select("path", F.try_parse_json("value").alias("v"))


MEMBERS = "archive string, ordinal int, archive_path string, size_bytes bigint, compressed_size_bytes bigint, encrypted boolean, error string, content binary"


def zip_members(files: DataFrame, most_members: int = MOST_MEMBERS, most_member_bytes: int = MOST_MEMBER_BYTES, most_total_bytes: int = MOST_TOTAL_BYTES) -> DataFrame:
    """The members of zip files (path, content), one row each; nothing is left out without an error.

    A member that is encrypted, above ``most_member_bytes`` or can't be read has its error and no content. An archive
    that is no zip file, or holds more members or bytes than the limits, has one row, with ordinal 0 and its error, and
    the others go on. Sizes are those that the archive states, and a member that holds more than it states has an error.
    Members come one by one, so that a worker holds one archive and one member at a time."""

    def whole(path: str, error: str) -> tuple:
        return path, 0, None, None, None, False, error, None

    def expand(path: str, content: bytes | None) -> Iterator[tuple]:
        try:
            archive = zipfile.ZipFile(io.BytesIO(content or b""))
        except Exception as e:  # the archive's fault becomes its row's error
            yield whole(path, f"{type(e).__name__}: {e}")
            return
        with archive as z:
            infos = [i for i in z.infolist() if not i.is_dir()]
            total = sum(i.file_size for i in infos)
            if len(infos) > most_members:
                yield whole(path, f"{len(infos)} members, at most {most_members}")
            elif total > most_total_bytes:
                yield whole(path, f"{total} bytes, at most {most_total_bytes}")
            else:
                for n, info in enumerate(infos, start=1):
                    data, error, locked = None, None, bool(info.flag_bits & 1)
                    if not locked and info.file_size <= most_member_bytes:
                        try:
                            data = z.read(info)
                        except Exception as e:  # the member's fault becomes its row's error
                            error = f"{type(e).__name__}: {e}"
                    elif not locked:
                        error = f"{info.file_size} bytes, at most {most_member_bytes}"
                    yield path, n, info.filename, info.file_size, info.compress_size, locked, error, data

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.large_binary()}
        fields = [(n, kinds[t]) for n, t in (c.split() for c in MEMBERS.split(", "))]
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist(), strict=True):
                for row in expand(path, content):
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(row, fields, strict=True)], [n for n, _ in fields])

    return files.select("path", "content").mapInArrow(run, MEMBERS)


def page_count(content: bytes | None, kind_: str | None) -> int | None:
    """How many pages a file has: those a PDF's page tree counts, the directories of a TIFF file, else 1; null for an
    archive, an unsupported file, and a PDF or TIFF file whose structure can't be read."""
    if content is None or kind_ in (None, "zip_archive", "unsupported"):
        return None
    if kind_ == "pdf":
        return _pdf_pages(content)
    if kind_ == "tiff":
        return _tiff_pages(content)
    return 1


def _pdf_pages(content: bytes) -> int | None:
    # The root of the page tree counts all pages below it, so the greatest count of a tree node is the file's; nodes
    # may lie in compressed object streams.
    parts = [content]
    for m in re.finditer(rb"/Type\s*/ObjStm\b.*?stream\r?\n", content, re.DOTALL):
        try:
            parts.append(zlib.decompressobj().decompress(content[m.end() :]))
        except zlib.error:
            continue
    counts = []
    for part in parts:
        for m in re.finditer(rb"/Type\s*/Pages\b", part):
            # The dictionary around the type: from the object's begin before it to its end behind it.
            a = max(part.rfind(b"obj", 0, m.start()), part.rfind(b">>", 0, m.start()), 0)
            b = min(x for x in (part.find(b"endobj", m.end()), part.find(b"/Type", m.end()), len(part)) if x >= 0)
            counts += [int(c) for c in re.findall(rb"/Count\s+(\d+)", part[a:b])]
    return max(counts, default=None)


def _tiff_pages(content: bytes) -> int | None:
    big = content[2:4] in (b"+\0", b"\0+")
    order = "<" if content[:2] == b"II" else ">"
    word, number, entry = (f"{order}Q", f"{order}Q", 20) if big else (f"{order}I", f"{order}H", 12)
    seen: set[int] = set()
    try:
        (at,) = struct.unpack_from(word, content, 8 if big else 4)
        while at and at not in seen:
            seen.add(at)
            (n,) = struct.unpack_from(number, content, at)
            (at,) = struct.unpack_from(word, content, at + struct.calcsize(number) + n * entry)
    except struct.error:
        return len(seen) or None
    return max(1, len(seen))


def with_page_count(files: DataFrame, content: str = "content", kind_: str = "kind") -> DataFrame:
    """``files`` with ``pages``."""

    @F.arrow_udf("int")
    def count(contents, kinds):
        import pyarrow as pa

        return pa.array([page_count(c.as_py(), k.as_py()) for c, k in zip(contents, kinds, strict=True)], pa.int32())

    return files.withColumn("pages", count(F.col(content), F.col(kind_)))


PAGES = "path string, page int, image binary, error string"


def load_page(content: bytes, kind_: str, page: int, dpi: int) -> bytes:
    """A page (from 0) as PNG: a PDF's rendered at dpi / 72 in RGB without alpha, a TIFF file's frame or a picture turned
    as its EXIF data says. Needs the packages pymupdf or Pillow."""
    if kind_ == "zip_archive":
        raise ValueError("the members of an archive are loaded, not the archive")
    if kind_ == "pdf":
        import pymupdf

        with pymupdf.open(stream=content, filetype="pdf") as document:
            if not 0 <= page < document.page_count:
                raise IndexError(f"no page {page}")
            return document[page].get_pixmap(matrix=pymupdf.Matrix(dpi / 72, dpi / 72), colorspace=pymupdf.csRGB, alpha=False).tobytes("png")
    from PIL import Image, ImageOps

    with Image.open(io.BytesIO(content)) as image:
        if not 0 <= page < (max(1, getattr(image, "n_frames", 1)) if kind_ == "tiff" else 1):
            raise IndexError(f"no page {page}")
        if kind_ == "tiff":
            image.seek(page)
        out = io.BytesIO()
        ImageOps.exif_transpose(image).convert("RGB").save(out, "PNG")
        return out.getvalue()


def load_pages(files: DataFrame, dpi: int = 250) -> DataFrame:
    """(path, page, image, error), as ``PAGES``, for files (path, content, kind, page); pages count from 0. A page that
    can't be loaded, also for want of the package that does it, has its error and no image."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                image, error = None, None
                try:
                    image = load_page(r["content"] or b"", r["kind"], r["page"], dpi)
                except Exception as e:  # the page's fault becomes its row's error
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([r["path"]]), pa.array([r["page"]], pa.int32()), pa.array([image], pa.large_binary()), pa.array([error], pa.string())], ["path", "page", "image", "error"])

    return files.select("path", "content", "kind", F.col("page").cast("int").alias("page")).mapInArrow(run, PAGES)


def missing_manifests(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """The pages of wanted (page) for which no manifest of found (page, ..) was saved."""
    return wanted.join(found.select("page").distinct(), "page", "left_anti")
