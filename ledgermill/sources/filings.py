"""Filing instance documents (XBRL) to fact rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.sources.batches import RowBuffer, named_contents

FACTS = (
    "source_path string, fact_index bigint, local_name string, value string, "
    "context_id string, unit_id string, label string"
)
_FACT_ROW = pa.schema(
    [
        ("source_path", pa.string()),
        ("fact_index", pa.int64()),
        ("local_name", pa.string()),
        ("value", pa.string()),
        ("context_id", pa.string()),
        ("unit_id", pa.string()),
        ("label", pa.string()),
    ]
)

# Where the public instance documents sit inside a filing.
PUBLIC_MEMBER = r"(^|/)XBRL/PublicDoc/[^/]+\.xbrl$"

_FEED = 1 << 20


class _Facts:
    """Reads the root's direct children that carry a context reference; ``ready`` holds the facts met so far."""

    def __init__(self, path: str):
        from xml.parsers import expat

        self.path, self.depth, self.count = path, 0, 0
        self.open: tuple | None = None
        self.text: list[str] = []
        self.ready: list[tuple] = []
        self.parser = expat.ParserCreate(namespace_separator="}")
        self.parser.buffer_text = True
        self.parser.StartElementHandler = self.start
        self.parser.EndElementHandler = self.end
        self.parser.CharacterDataHandler = self.characters

    def start(self, tag, attributes):
        self.depth += 1
        if self.depth == 2 and "contextRef" in attributes:
            self.open = (tag.rpartition("}")[2], attributes["contextRef"], attributes.get("unitRef"))
            self.text = []

    def characters(self, data):
        if self.open is not None and self.depth == 2:
            self.text.append(data)

    def end(self, _):
        if self.depth == 2 and self.open is not None:
            name, context, unit = self.open
            value = "".join(self.text) if self.text else None
            self.ready.append((self.path, self.count, name, value, context, unit, None))
            self.count += 1
            self.open = None
        self.depth -= 1

    def feed(self, content: bytes) -> Iterator[list[tuple]]:
        """Facts in the order of the document, a piece of it at a time."""
        for at in range(0, len(content), _FEED):
            self.parser.Parse(content[at : at + _FEED], False)
            yield self.ready
            self.ready = []
        self.parser.Parse(b"", True)
        yield self.ready


def _well_formed(content: bytes) -> bool:
    from xml.parsers import expat

    try:
        expat.ParserCreate().Parse(content, True)
        return True
    except expat.ExpatError:
        return False


def filing_facts(documents: DataFrame, skip_bad: bool = False) -> DataFrame:
    """Fact rows of a document table ``(source_path, content)``.

    ``fact_index`` numbers the facts of one document in document order. ``skip_bad`` leaves out documents that are not
    well-formed; otherwise such a document fails the job. Facts leave the task in bounded batches, so a task holds one
    document's bytes and not its facts.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xml.parsers import expat

        out = RowBuffer(_FACT_ROW)
        for path, content in named_contents(batches):
            if skip_bad and not _well_formed(content):
                continue
            try:
                for facts in _Facts(path).feed(content):
                    for fact in facts:
                        out.add(fact, len(fact[3] or ""))
                        if out.full():
                            yield from out.take()
            except expat.ExpatError as e:
                raise ValueError(f"{path} is not a well-formed document: {e}") from e
        yield from out.take()

    return documents.select("source_path", "content").mapInArrow(parse, FACTS)


def scan_filings(spark: SparkSession, paths: str | Sequence[str], skip_bad: bool = False) -> DataFrame:
    """Fact rows of every public instance document below the paths (folders that archives were expanded into)."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.xbrl")
        .option("recursiveFileLookup", True)
        .load(paths)
        .filter(F.col("path").rlike(PUBLIC_MEMBER))
    )
    return filing_facts(files.select(F.col("path").alias("source_path"), "content"), skip_bad)


def filing_documents(members: DataFrame) -> DataFrame:
    """Public instance documents ``(source_path, content)`` of an archive member table."""
    inside = members.filter(F.col("member").rlike(PUBLIC_MEMBER))
    return inside.select(F.concat_ws("/", "archive", "member").alias("source_path"), "content")
