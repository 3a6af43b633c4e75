"""Full replacement of output tables: one, or several at once."""

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from erabridge.sources.shared import remove_folder

NAME_PART = re.compile(r"`((?:[^`]|``)+)`|([^.`]+)")


def name_parts(table: str) -> list[str]:
    """Catalog, schema and name of a table, as far as given.

    A part in backquotes may hold any sign, also a dot; others are taken as
    they are, so a name with a hyphen needs no quotes.
    """
    parts, at = [], 0
    while True:
        found = NAME_PART.match(table, at)
        if found is None:
            raise ValueError(f"not a table name: {table!r}")
        quoted, plain = found.groups()
        parts.append(quoted.replace("``", "`") if quoted else plain.strip())
        at = found.end()
        if at == len(table):
            return parts
        if table[at] != ".":
            raise ValueError(f"not a table name: {table!r}")
        at += 1


def quoted(parts: Iterable[str]) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


@dataclass
class Replacement:
    """A complete staging table, and the table that it shall replace.

    ``swap`` makes the new rows the table's, ``undo`` takes that back, and
    ``finish`` clears away what is left of the old table or, without a swap,
    of the new one.
    """

    spark: SparkSession
    parts: list[str]
    run: str
    location: str | None
    folder: str | None
    swapped: str | None = None
    old_folder: str | None = None

    def name(self, suffix: str = "") -> str:
        ending = f"__{suffix}_{self.run}" if suffix else ""
        return quoted([*self.parts[:-1], self.parts[-1] + ending])

    def swap(self) -> None:
        """In one step where old and new have one layout and lie at locations.

        The table then never lacks, since it only changes the folder it reads.
        Otherwise the tables trade names; if the second half of the trade
        fails, the first is taken back.
        """
        table, staging = self.name(), self.name("staging")
        if not self.spark.catalog.tableExists(table):
            self._sql(f"ALTER TABLE {staging} RENAME TO {table}")
            self.swapped = "new"
            return
        old = self._folder_to_swap()
        if old is not None:
            self._point_to(self.folder)
            self.swapped, self.old_folder = "folder", old
            return
        retired = self.name("retired")
        self._sql(f"ALTER TABLE {table} RENAME TO {retired}")
        try:
            self._sql(f"ALTER TABLE {staging} RENAME TO {table}")
        except Exception:
            self._sql(f"ALTER TABLE {retired} RENAME TO {table}")
            raise
        self.swapped = "name"

    def undo(self) -> None:
        table, staging = self.name(), self.name("staging")
        if self.swapped == "folder":
            self._point_to(self.old_folder)
        elif self.swapped:
            self._sql(f"ALTER TABLE {table} RENAME TO {staging}")
            if self.swapped == "name":
                self._sql(f"ALTER TABLE {self.name('retired')} RENAME TO {table}")
        self.swapped = None

    def finish(self) -> None:
        if self.swapped == "name":
            self._sql(f"DROP TABLE {self.name('retired')}")
        elif self.swapped != "new":
            self._sql(f"DROP TABLE IF EXISTS {self.name('staging')}")
        if self.swapped is None and self.folder is not None:
            remove_folder(self.spark, self.folder)

    def _sql(self, statement: str) -> None:
        self.spark.sql(statement)

    def _point_to(self, folder: str) -> None:
        place = folder.replace("\\", "\\\\").replace("'", "\\'")
        self._sql(f"ALTER TABLE {self.name()} SET LOCATION '{place}'")
        self.spark.catalog.refreshTable(self.name())

    def _folder_to_swap(self) -> str | None:
        """Where the old table lies, if changing that is all a swap takes."""
        if self.folder is None:
            return None
        old, new = (self._described(t) for t in (self.name(), self.name("staging")))
        if old.get("Type") != "EXTERNAL" or old.get("Provider") != new.get("Provider"):
            return None
        same = [self.spark.table(t).schema for t in (self.name(), self.name("staging"))]
        return old.get("Location") if same[0] == same[1] else None

    def _described(self, table: str) -> dict[str, str]:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
        return {row.col_name: row.data_type for row in rows}


def refuse_view(spark: SparkSession, table: str) -> None:
    """Raises if ``table`` names a view, which can't be replaced by a table."""
    name = quoted(name_parts(table))
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if kind in ("VIEW", "TEMPORARY"):
            raise ValueError(f"{table} is a view")


def stage(
    df: DataFrame, table: str, location: str | None = None, fmt: str = "parquet"
) -> Replacement:
    """Writes ``df`` to a staging table beside ``table``; a failure leaves none."""
    spark = df.sparkSession
    refuse_view(spark, table)
    parts, run = name_parts(table), uuid.uuid4().hex[:12]
    folder = None
    writer = df.write.format(fmt).mode("errorifexists")
    if location is not None:
        plain = re.sub(r"\W", "_", parts[-1])
        folder = f"{location.rstrip('/')}/{plain}__staging_{run}"
        writer = writer.option("path", folder)
    staged = Replacement(spark, parts, run, location, folder)
    try:
        writer.saveAsTable(staged.name("staging"))
    except Exception:
        staged.finish()
        raise
    return staged


def swap_all(staged: list[Replacement]) -> None:
    """Swaps every table or, on any failure, none; staging tables go either way.

    Each table is put back by itself: where one can't be, the others are all the same,
    and of that one neither the old nor the new rows are dropped.
    """
    stuck: list[Replacement] = []
    try:
        for one in staged:
            one.swap()
    except Exception as failure:
        for one in reversed(staged):
            try:
                one.undo()
            except Exception as second:
                stuck.append(one)
                failure.add_note(f"{one.name()} could not be put back: {second}")
        raise
    finally:
        for one in staged:
            if not any(one is other for other in stuck):
                one.finish()


def replace_table(
    df: DataFrame, table: str, location: str | None = None, fmt: str = "parquet"
) -> None:
    """Write ``df`` as ``table``, replacing what was there.

    The rows go to a staging table, which takes the table's place once it is
    complete. A failure at any step leaves the old table as it was and no
    staging table or folder, and ``df`` may itself read that table. A view is
    refused before anything is written.

    Files go to the session's warehouse or, with ``location``, to a new folder
    under it. The second way suits object stores: no files move, a table of
    unchanged layout is switched over in one step, and the old files stay for
    whoever still reads them.
    """
    swap_all([stage(df, table, location, fmt)])
