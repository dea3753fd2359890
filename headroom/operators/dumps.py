"""Command dumps: lines of text files to services, paths and directories.

A unit's name is carried down the lines of its file by a window over the file. Dump files are small;
many files make many groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as P

HOST_MARK = r"^====\s*(.*?)\s*====$"
UNIT_MARK = r"^---\s+(.+?)\s+---$"
HEAD = 10


def unit_lines(lines: DataFrame) -> DataFrame:
    """(file, host, unit, line_no, line) of the lines (file, line_no from 0, line) that stand in a unit."""
    s = F.trim("line")
    mark = F.when(s.rlike(UNIT_MARK), F.btrim(s, F.lit("- "))).when(s.startswith("●"), F.get(F.split(F.ltrim(s, F.lit("● ")), r"\s+"), F.lit(0)))
    marked = lines.select("file", "line_no", "line", mark.alias("mark"), F.when((F.col("line_no") < HEAD) & s.rlike(HOST_MARK), F.regexp_extract(s, HOST_MARK, 1)).alias("host_mark"))
    by = Window.partitionBy("file").orderBy("line_no")
    whole = Window.partitionBy("file")
    told = marked.withColumns({"unit": F.last("mark", ignorenulls=True).over(by), "first_host": F.min(F.when(F.col("host_mark").isNotNull(), F.struct("line_no", "host_mark"))).over(whole)})
    return told.filter("unit is not null").select("file", F.coalesce("first_host.host_mark", P.host_of_file(F.col("file"))).alias("host"), F.trim("unit").alias("unit"), "line_no", "line", F.col("mark").isNotNull().alias("is_mark"))


def errors(captures: DataFrame) -> DataFrame:
    """(host, file, message) of captures (host, file, exit_code, text) that say nothing: failed, unreadable or without a unit."""
    lines = F.split(F.coalesce("text", F.lit("")), "\r?\n")
    unit = F.exists(lines, lambda x: F.trim(x).rlike(UNIT_MARK) | F.trim(x).startswith("●"))
    message = F.when(F.coalesce("exit_code", F.lit(0)) != 0, F.concat(F.lit("scan failed: exit code "), F.col("exit_code").cast("string"))).when(F.col("text").isNull(), "read error").when(F.btrim("text", F.lit(" \t\r\n")) == "", "empty file").when(~unit, "no unit found")
    return captures.select(F.coalesce("host", P.host_of_file(F.col("file"))).alias("host"), "file", message.alias("message")).filter("message is not null")


def services(units: DataFrame) -> DataFrame:
    """(host, unit, status, main_pid): the last status and pid line of each unit."""
    s = F.trim("line")
    last = lambda c: F.coalesce(F.max_by(s, F.when(c, F.col("line_no"))), F.lit(""))
    taken = s.startswith("ExecStart=") | s.startswith("FragmentPath=") | s.startswith("EnvironmentFile=") | F.col("is_mark")
    status = ~taken & s.startswith("Active:")
    rows = units.groupBy("file", "host", "unit").agg(last(status).alias("status"), last(~taken & ~status & s.contains("Main PID")).alias("main_pid"))
    return rows.select("host", "unit", "status", "main_pid").distinct()


def unit_paths(units: DataFrame) -> DataFrame:
    """Distinct (host, unit, kind, path): by property, and by the path itself."""
    s = F.trim("line")
    role = F.when(s.startswith("ExecStart="), "exec").when(s.startswith("FragmentPath="), "unit_fragment").when(s.startswith("EnvironmentFile="), "env_file")
    rows = units.filter("not is_mark").select("host", "unit", role.alias("role"), F.explode(P.line_paths(F.col("line"))).alias("path"))
    return rows.select("host", "unit", F.explode(F.array_compact(F.array(F.col("role"), P.dump_kind(F.col("path"))))).alias("kind"), "path").distinct()


def unit_dirs(paths: DataFrame) -> DataFrame:
    """Distinct (host, kind, directory) of unit_paths."""
    kind = F.when(F.col("kind") == "exec", "app_dir").when(F.col("kind").isin("log", "config", "certificate", "data"), F.concat("kind", F.lit("_dir")))
    return paths.select("host", kind.alias("kind"), P.parent(F.col("path")).alias("directory")).filter("kind is not null").distinct()
