"""Domains, directories and paths derived from unit properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P

#: Accounts by domain suffix, in the order of declaration. Which there are is a parameter of the jobs.
Accounts = dict[str, str]


def domain_of(host: Column, accounts: Accounts, longest: bool = False) -> Column:
    """Suffix of a host: the first declared, or the longest, that it ends with; else ''."""
    low = F.lower(F.coalesce(host, F.lit("")))
    out = F.lit("")
    for suffix in reversed(sorted(accounts, key=len, reverse=True) if longest else list(accounts)):
        out = F.when(low.endswith(suffix), suffix).otherwise(out)
    return out


def account_of(domain: Column, accounts: Accounts) -> Column:
    if not accounts:
        return F.lit("")
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in accounts.items() for x in kv]), domain), F.lit(""))


def with_domain(rows: DataFrame, accounts: Accounts, host: str = "host_ref", longest: bool = False) -> DataFrame:
    return rows.withColumn("domain", domain_of(F.col(host), accounts, longest)).withColumn("account", account_of(F.col("domain"), accounts))


def domain_paths(paths: DataFrame, accounts: Accounts) -> DataFrame:
    """paths (system, role, host_ref, path, kind, ...) with domain, account and the certificate rule."""
    return with_domain(paths, accounts).withColumn("kind", P.certificate_kind(F.col("path"), F.col("kind")))


def domain_dirs(paths: DataFrame) -> DataFrame:
    """Distinct directories of domain_paths."""
    return paths.select("domain", "account", F.col("host_ref").alias("host"), "system", "role", "kind", P.parent(F.col("path")).alias("directory")).distinct()


def loaded_paths(paths: DataFrame) -> DataFrame:
    """(host, path, kind) of an inventory: blanks dropped, a missing kind from the path."""
    path = F.trim(F.coalesce("path", F.lit("")))
    kind = F.col("kind") if "kind" in paths.columns else F.lit(None).cast("string")
    return paths.filter((F.trim(F.coalesce("host", F.lit(""))) != "") & (path != "")).select("host", path.alias("path"), F.coalesce(F.when(F.trim(kind) != "", kind), P.file_kind(path)).alias("kind"))


def derived_paths(known: DataFrame, units: DataFrame) -> DataFrame:
    """known (host, path, kind) and what the properties of units (host, unit, lines) tell besides."""
    p = units.withColumn("p", P.properties(F.col("lines")))
    get = lambda k: F.trim(F.coalesce(F.try_element_at("p", F.lit(k)), F.lit("")))
    row = lambda path, kind, n: F.struct(path.alias("path"), kind.alias("kind"), F.lit(n).alias("n"))
    binary = P.first_absolute(get("ExecStart"))
    files = F.filter(F.split(get("EnvironmentFile"), r"\s+"), lambda x: x != "")
    told = F.concat(
        F.array(row(get("FragmentPath"), F.lit("config_file"), 1)),
        F.transform(files, lambda x: row(x, P.file_kind(x), 2)),
        F.array(row(F.coalesce(binary, F.lit("")), F.lit("binary_file"), 3), row(F.coalesce(P.parent(binary), F.lit("")), F.lit("service_dir"), 4)),
    )
    new = p.select("host", F.explode(told).alias("d")).select("host", "d.*").filter("path <> ''").groupBy("host", "path").agg(F.min_by("kind", "n").alias("kind"))
    fresh = new.join(known.select("host", "path").distinct(), ["host", "path"], "left_anti")
    return known.select("host", "path", "kind", F.lit("inventory").alias("source")).unionByName(fresh.select("host", "path", "kind", F.lit("systemd").alias("source")))


def verified_dirs(verified: DataFrame) -> DataFrame:
    """Distinct (host, directory, kind) of verified paths (host, path, kind, exists, type) that exist."""
    own = F.regexp_replace("path", "(?<=.)/+$", "")
    return verified.filter("exists = 'yes'").select("host", F.when(F.col("type") == "dir", own).otherwise(P.parent(F.col("path"))).alias("directory"), P.directory_kind(F.col("kind")).alias("kind")).distinct()
