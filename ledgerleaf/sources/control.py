"""Control inputs: targets, formats by address, batch jobs, settings. All are small and live on the driver."""

from __future__ import annotations

import argparse
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.fixed_values import FALSE_WORDS, FORMAT_URLS, TARGETS, TRUE_WORDS

ENV_PREFIX = "LEDGERLEAF_"
LOCAL_CONFIG = re.compile(r"\.?((config|conf)[-._]?ledgerleaf|ledgerleaf[-._]?(config|conf))\.ya?ml", re.IGNORECASE)
FORMATS = [name for name, _ in FORMAT_URLS]


class NoFormatDetected(Exception):
    """Neither selected nor found by address."""


def targets(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(ord, target): the built-in list, or the first column of a CSV file with a header; blank rows are left out."""
    names = TARGETS
    if path:
        import csv

        rows = [r[0] for r in csv.reader("\n".join(x.value for x in spark.read.text(path, wholetext=True).collect()).splitlines()) if r and r[0].strip()]
        names = rows[1:]
    return spark.createDataFrame(list(enumerate(names)), "ord int, target string")


def target_list(frame: DataFrame) -> list[str]:
    return [r["target"] for r in frame.orderBy("ord").collect()]


def detect_format(url: Column, formats: list[tuple[str, str]] = FORMAT_URLS) -> Column:
    """The last format of the list whose pattern is found in the address; null for none."""
    out = F.lit(None).cast("string")
    for name, pattern in formats:
        out = F.when(url.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def format_of(url: str | None, formats: list[tuple[str, str]] = FORMAT_URLS) -> str | None:
    """As detect_format, for one address on the driver."""
    return next((name for name, pattern in reversed(formats) if url and re.search(pattern, url)), None)


def detect_formats(rows: DataFrame, formats: DataFrame, key: str, url: str) -> DataFrame:
    """(key, format) by a table of formats (ord, format, pattern), a control input of a few dozen rows: patterns leave no key to join by."""
    hit = rows.select(key, url).join(formats, F.expr(f"`{url}` RLIKE pattern"))
    return hit.groupBy(key).agg(F.max_by("format", "ord").alias("format"))


def reconcile(selected: Column, detected: Column) -> Column:
    """(format, mismatch): the selected format wins; mismatch if the two differ."""
    return F.struct(F.coalesce(selected, detected).alias("format"), F.coalesce(selected != detected, F.lit(False)).alias("mismatch"))


def reconcile_format(selected: str | None, detected: str | None) -> str:
    if selected is None and detected is None:
        raise NoFormatDetected("no format was selected and the address matches none")
    return selected or detected


def to_bool(word: str) -> bool:
    w = word.strip().lower()
    if w in TRUE_WORDS:
        return True
    if w in FALSE_WORDS:
        return False
    raise ValueError(f"{word!r} is none of {TRUE_WORDS} or {FALSE_WORDS}")


def to_format(word: str) -> str:
    if word.strip() not in FORMATS:
        raise ValueError(f"{word!r} is no known format")
    return word.strip()


@dataclass(frozen=True)
class Settings:
    """Defaults, overlaid in turn by a file, the environment, the command line and a job; origin says where each came from."""

    verbosity: int = 2
    n_workers: int = field(default_factory=lambda: os.process_cpu_count() or 1)
    batch: str | None = None
    out: str = "/dev/stdout"
    separate_out: bool = False
    save_pdf: bool = True
    url: str | None = None
    pdf: str | None = None
    format: str | None = None
    prefix_out: str | None = None
    config_file: str | None = None
    origin: dict[str, str] = field(default_factory=dict, compare=False)

    def overlay(self, values: dict, origin: str) -> Settings:
        known = {f.name for f in fields(self)} - {"origin"}
        if unknown := set(values) - known:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return replace(self, **values, origin=self.origin | dict.fromkeys(values, origin))

    def validated(self) -> Settings:
        if not 0 <= self.verbosity <= 5:
            raise ValueError(f"verbosity must be from 0 to 5, not {self.verbosity}")
        if self.url is None and self.pdf is None:
            raise ValueError("an address, a file or both are needed")
        out = Path(self.out)
        if not out.parent.exists():
            raise ValueError(f"the directory {out.parent} doesn't exist")
        if self.batch is not None:
            if not Path(self.batch).is_file():
                raise ValueError(f"the batch file {self.batch} doesn't exist")
            if self.separate_out and "." in out.name and not out.name.endswith(".tar.gz"):
                raise ValueError("separate files go to a directory or a .tar.gz archive")
        return self

    def described(self) -> str:
        """All settings, each with where it came from."""
        return ", ".join(f"{f.name}={getattr(self, f.name)!r} ({self.origin.get(f.name, 'default')})" for f in fields(self) if f.name != "origin")

    def log_level(self) -> int:
        return (5 - self.verbosity) * 10


_CASTS = {"verbosity": int, "n_workers": int, "batch": str, "out": str, "separate_out": to_bool, "save_pdf": to_bool, "url": str, "pdf": str, "format": to_format, "config_file": str}
_FILE_NAMES = {"verbosity": "verbosity", "n_workers": "n_workers", "pdf": "pdf", "url": "url", "batch_path": "batch", "separate_out": "separate_out", "out_path": "out", "save_pdf": "save_pdf", "format": "format"}
_JOB_NAMES = {"url": ("url", str), "save pdf": ("save_pdf", to_bool), "format": ("format", to_format), "pdf": ("pdf", str), "prefix out": ("prefix_out", str)}


def config_folders(env: Mapping[str, str], home: str, windows: bool) -> list[str]:
    """Where settings files of the user, then of all users, then of the system lie."""
    if windows:
        return [env.get("LOCALAPPDATA") or os.path.join(home, "AppData", "Local"), env.get("PROGRAMDATA") or "C:\\ProgramData", env.get("SystemRoot") or "C:\\Windows"]
    shared = (env.get("XDG_CONFIG_DIRS") or "/etc/xdg").split(":")
    return [env.get("XDG_CONFIG_HOME") or os.path.join(home, ".config"), *shared, "/etc"]


def find_config(home: str | None = None, here: str = ".", env: Mapping[str, str] | None = None, windows: bool = os.name == "nt") -> str | None:
    """The settings file to read: one in the working directory, hidden or not, whose name is the program's and `config` or `conf` in
    either order and any case, joined by `-`, `_`, `.` or nothing; else `ledgerleaf.yaml` or `.yml` in the first folder that has it."""
    for name in sorted(os.listdir(here)):
        if LOCAL_CONFIG.fullmatch(name) and os.path.isfile(p := os.path.join(here, name)):
            return p
    for d in config_folders(os.environ if env is None else env, home or os.path.expanduser("~"), windows):
        for name in ("ledgerleaf.yaml", "ledgerleaf.yml"):
            if os.path.isfile(p := os.path.join(d, name)):
                return p
    return None


def from_file(settings: Settings, path: str) -> Settings:
    import yaml

    read = yaml.safe_load(Path(path).read_text()) or {}
    if unknown := set(read) - set(_FILE_NAMES):
        raise ValueError(f"unknown settings in {path}: {sorted(unknown)}")
    cast = lambda k, v: v if isinstance(v, bool) else _CASTS[k](str(v))
    return settings.overlay({_FILE_NAMES[k]: cast(_FILE_NAMES[k], v) for k, v in read.items()}, "file")


def from_environment(settings: Settings, env: dict[str, str] | None = None) -> Settings:
    env = os.environ if env is None else env
    names = {f"{ENV_PREFIX}{'OUT_CSV' if k == 'out' else k.upper()}": k for k in _CASTS}
    return settings.overlay({k: _CASTS[k](env[n]) for n, k in names.items() if n in env}, "environment")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerleaf", description="Turn fund reports into a table of holdings.")
    p.add_argument("--url", "-u")
    p.add_argument("--pdf", "-i")
    p.add_argument("--batch", "-b")
    p.add_argument("--workers", "-j", type=int)
    p.add_argument("--format", "-f", choices=FORMATS)
    p.add_argument("--no-download", action="store_true")
    p.add_argument("--separate-out", action="store_true")
    p.add_argument("--config")
    p.add_argument("--out", "-o")
    p.add_argument("-v", action="count")
    p.add_argument("-q", action="count")
    return p


def from_arguments(settings: Settings, args: argparse.Namespace) -> Settings:
    if args.v is not None and args.q is not None:
        raise argparse.ArgumentTypeError("-v and -q exclude each other")
    values = {k: v for k, v in (("url", args.url), ("pdf", args.pdf), ("batch", args.batch), ("format", args.format), ("config_file", args.config), ("out", args.out)) if v is not None}
    if args.workers is not None:
        values["n_workers"] = args.workers if args.workers > 0 else os.process_cpu_count() or 1
    if args.no_download:
        values["save_pdf"] = False
    if args.separate_out:
        values["separate_out"] = True
    if args.v or args.q:
        values["verbosity"] = min(5, max(0, settings.verbosity + (args.v or 0) - (args.q or 0)))
    return settings.overlay(values, "command line")


def configure(argv: list[str] | None = None, env: dict[str, str] | None = None) -> Settings:
    """default < file < environment < command line."""
    args = parser().parse_args(argv)
    env = dict(os.environ) if env is None else env
    path = args.config or env.get(f"{ENV_PREFIX}CONFIG_FILE") or find_config()
    settings = Settings()
    if path:
        settings = from_file(settings.overlay({"config_file": path}, "default"), path)
    return from_arguments(from_environment(settings, env), args)


def batch_jobs(path: str, base: Settings) -> list[Settings]:
    """One Settings for each row of a CSV file whose header is trimmed and lower-cased; empty cells leave the base's values."""
    import csv

    with open(path, newline="") as f:
        rows = list(csv.reader(f))
    names = [x.strip().lower() for x in rows[0]] if rows else []
    jobs = []
    for row in rows[1:]:
        values = {_JOB_NAMES[n][0]: _JOB_NAMES[n][1](v.strip()) for n, v in zip(names, row, strict=False) if n in _JOB_NAMES and v.strip()}
        jobs.append(base.overlay(values, "job"))
    return jobs
