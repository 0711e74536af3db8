"""Run options: layered configuration, engine dispatch, checks, and a dry run that says what would be done. Driver-side only."""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def load_json(path: str | None) -> dict[str, Any]:
    """A configuration file, or nothing where there is none."""
    if not path or not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def setting(config: dict[str, Any], *paths: str, default: Any = None) -> Any:
    """The first value along dotted paths that isn't empty."""
    for path in paths:
        value: Any = config
        for key in path.split("."):
            value = value.get(key) if isinstance(value, dict) else None
        if value:
            return value
    return default


def setting_column(*values: Column, default: Any = None) -> Column:
    """setting() over columns: the first that isn't null or empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(default))


def resolve_columns(output_dir: Column, configured_dir: Column, engine: Column, force_ocr: Column, configured_force: Column) -> dict[str, Column]:
    """PipelineOptions.resolve() over columns, for tables of runs: output_root, ocr_fallback, force_ocr."""
    return {
        "output_root": setting_column(output_dir, configured_dir, default=PipelineOptions.output_root),
        "ocr_fallback": dispatch_column(setting_column(engine, default="ensemble")),
        "force_ocr": F.coalesce(force_ocr, F.lit(False)) | F.coalesce(configured_force, F.lit(False)),
    }


def dispatch(engine: str) -> str | None:
    """The kind of recognition that an engine name asks for; None if it isn't known."""
    name = engine.lower()
    kinds = {"paddle": "paddle", "ensemble": "ensemble", "multi": "ensemble"}
    return next((kind for prefix, kind in kinds.items() if name.startswith(prefix)), None)


def dispatch_column(engine: Column) -> Column:
    name = F.lower(engine)
    return F.when(name.startswith("paddle"), "paddle").when(name.startswith("ensemble") | name.startswith("multi"), "ensemble")


@dataclass(frozen=True)
class PipelineOptions:
    inputs: str | None = "data/input_pdfs"
    manifest: str | None = None
    output_root: str = "reports/output"
    ocr_fallback: str | None = "ensemble"
    force_ocr: bool = False
    prefer_text_layer: bool = True
    profile: str | None = None
    progress_csv: str | None = None
    status_bar: bool = False
    passthrough: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        if self.force_ocr and not self.ocr_fallback:
            raise ValueError("forcing OCR needs an OCR fallback (paddle or ensemble)")

    @classmethod
    def resolve(cls, config: dict[str, Any] | str | None = None, *, input_dir: str | None = None, input_file: str | None = None, output_dir: str | None = None, engine: str | None = None, force_ocr: bool = False, **more: Any) -> PipelineOptions:
        """Arguments first, then the configuration, then the defaults; a single file beats a folder."""
        config = load_json(config) if isinstance(config, str) else config or {}
        if input_file and not os.path.exists(input_file):
            raise FileNotFoundError(input_file)
        return cls(
            inputs=None if input_file else input_dir or setting(config, "input.input_directory", "paths.input_dir", default=cls.inputs),
            manifest=input_file,
            output_root=output_dir or setting(config, "output.output_directory", "paths.output_dir", default=cls.output_root),
            ocr_fallback=dispatch(engine or setting(config, "ocr.engine", default="ensemble")),
            force_ocr=force_ocr or bool(setting(config, "ocr.force_ocr_on_text_layer", default=False)),
            **more,
        )

    def arguments(self) -> list[str]:
        """The options as arguments of the command page-text, with what was passed through at the end."""
        flags = [("--manifest", self.manifest), ("--inputs", None if self.manifest else self.inputs), ("--output-root", self.output_root), ("--prefer-text-layer", self.prefer_text_layer), ("--ocr-fallback", self.ocr_fallback)]
        flags += [("--force-ocr", self.force_ocr), ("--status-bar", self.status_bar), ("--profile", self.profile), ("--progress-csv", self.progress_csv)]
        return [x for name, value in flags if value for x in ([name] if value is True else [name, str(value)])] + list(self.passthrough)

    @classmethod
    def from_arguments(cls, arguments: Sequence[str]) -> PipelineOptions:
        """From arguments of the command page-text; the last of repeated ones counts."""
        parser = argparse.ArgumentParser(prog="page-text", allow_abbrev=False)
        for name in ("inputs", "manifest", "output-root", "profile", "progress-csv"):
            parser.add_argument(f"--{name}")
        parser.add_argument("--ocr-fallback", choices=("paddle", "ensemble", "none"))
        for name in ("prefer-text-layer", "force-ocr", "status-bar"):
            parser.add_argument(f"--{name}", action="store_true")
        given = {k: v for k, v in vars(parser.parse_args(list(arguments))).items() if v is not None}
        return cls(**given | {"ocr_fallback": None if given.get("ocr_fallback", "none") == "none" else given["ocr_fallback"], "inputs": None if given.get("manifest") else given.get("inputs")})

    def settled(self) -> PipelineOptions:
        """With what was passed through applied, as if it had been said last."""
        return replace(PipelineOptions.from_arguments(self.arguments()), passthrough=())

    def explain(self) -> str:
        """What a run would do, one option a line, and the arguments that say so."""
        said = [f"{k}: {v}" for k, v in vars(self).items() if v not in (None, (), False)]
        return "\n".join(["extract_pages", *said, "Mapped command:", "quorumtext page-text " + " ".join(self.arguments())])


def validate(config_path: str | None = None, input_dir: str | None = None, input_file: str | None = None) -> list[str]:
    """Everything that is wrong with the paths given; those not given aren't looked at."""
    wrong = []
    if config_path and not os.path.exists(config_path):
        wrong.append(f"no configuration at {config_path}")
    if input_dir and not os.path.isdir(input_dir):
        wrong.append(f"no folder at {input_dir}")
    if input_file and not os.path.isfile(input_file):
        wrong.append(f"no file at {input_file}")
    return wrong


@dataclass(frozen=True)
class EnsembleProfile:
    """The settings of recognition and fusion that a profile file may hold."""

    dpi: int = 300
    engines: tuple[str, ...] = ("paddle", "doctr", "mmocr", "kraken")
    weights: dict[str, float] = field(default_factory=dict)
    angles: tuple[int, ...] = (0, 90, 180, 270)
    layout: dict[str, Any] = field(default_factory=dict)
    preprocessing: dict[str, Any] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | None) -> EnsembleProfile:
        p = load_json(path)
        known = ("detect_multi_column", "min_lines_for_columns", "column_gap_ratio", "column_overlap_ratio")
        angles = p.get("preprocessing", {}).get("rotation_search_degrees", cls.angles)
        return cls(
            dpi=int(p.get("rendering", {}).get("dpi", cls.dpi)),
            engines=tuple(n for n in (p.get("engines", {}).get("enabled") or cls.engines) if n in cls.engines),
            weights=dict(p.get("fusion", {}).get("weights", {})),
            angles=tuple(int(a) % 360 for a in angles) or (0,),
            layout={k: v for k, v in p.get("layout", {}).items() if k in known},
            preprocessing=dict(p.get("preprocessing", {})),
        )
