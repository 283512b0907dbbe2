"""Release specifications, read from YAML into typed settings that become Column predicates."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class ExportSpec:
    max_darkness: float | None = None
    min_aspect: float | None = None
    max_aspect: float | None = None
    allow_calipers: bool = True
    min_year: int | None = None
    max_year: int | None = None
    required: list[str] = field(default_factory=list)
    allow_scanners: list[str] = field(default_factory=list)
    deny_scanners: list[str] = field(default_factory=list)
    split_bilateral: bool = True
    keep_unknown_side: bool = False
    test_share: float = 0.15
    validation_share: float = 0.15
    mini_share: float = 0.0
    seed: int = 42

    @classmethod
    def from_dict(cls, values: dict) -> ExportSpec:
        """Unknown settings are an error; absent ones keep their default."""
        known = {f.name for f in fields(cls)}
        if unknown := set(values) - known:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        return cls(**values)

    @classmethod
    def from_yaml(cls, text: str) -> ExportSpec:
        import yaml

        return cls.from_dict(yaml.safe_load(text) or {})


def rules(spec: ExportSpec) -> list[tuple[str, Column]]:
    """Exclusion rules (name, condition) of image rows; absent measurements exclude nothing."""
    aspect = F.round(F.col("crop_w") / F.col("crop_h"), 2)
    year = F.year("acquired")
    out = []
    if spec.max_darkness is not None:
        out.append(("dark", F.col("darkness") > spec.max_darkness))
    if spec.min_aspect is not None:
        out.append(("narrow", aspect < spec.min_aspect))
    if spec.max_aspect is not None:
        out.append(("wide", aspect > spec.max_aspect))
    if not spec.allow_calipers:
        out.append(("calipers", F.col("has_calipers") != 0))
    if spec.min_year is not None:
        out.append(("too_early", F.coalesce(year < spec.min_year, F.lit(True))))
    if spec.max_year is not None:
        out.append(("too_late", F.coalesce(year > spec.max_year, F.lit(True))))
    for c in spec.required:
        out.append((f"no_{c}", F.col(c).isNull()))
    if spec.allow_scanners:
        out.append(("scanner", ~F.col("scanner").isin(*spec.allow_scanners)))
    elif spec.deny_scanners:
        out.append(("scanner", F.col("scanner").isin(*spec.deny_scanners)))
    return out


def build_predicate(spec: ExportSpec) -> Column:
    """The rows that no rule excludes."""
    keep = F.lit(True)
    for _, condition in rules(spec):
        keep = keep & ~F.coalesce(condition, F.lit(False))
    return keep
