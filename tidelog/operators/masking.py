"""Masking of personal and health data by column name; all expressions are native."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalar import hmac_sha256_hex, sha256_hex


@dataclass(frozen=True)
class Rules:
    """Parts of names, health first. `strategies` overrides by column: hash, tokenize or passthrough."""

    # Fixed values.
    phi: tuple[str, ...] = ("medical_record_number", "patient_id", "diagnosis", "prescription")
    pii: tuple[str, ...] = ("email", "phone", "ssn", "credit_card", "address")
    strategies: dict[str, str] = field(default_factory=dict)
    key: str | None = None
    salt: str = ""

    @classmethod
    def load(cls, path: str, **more) -> Rules:
        import yaml

        with open(path, encoding="utf-8") as f:
            found = yaml.safe_load(f) or {}
        return cls(phi=tuple(found.get("phi_fields", cls.phi)), pii=tuple(found.get("pii_fields", cls.pii)), **more)

    def classify(self, name: str) -> str:
        """phi_token, pii_hash or none: a part of the name decides, whatever its case."""
        low = name.lower()
        if name in self.strategies:
            return {"hash": "pii_hash", "tokenize": "phi_token", "passthrough": "none"}[self.strategies[name]]
        return "phi_token" if any(x in low for x in self.phi) else "pii_hash" if any(x in low for x in self.pii) else "none"

    def classified(self, name: Column) -> Column:
        """classify() of names in a column."""
        low, none = F.lower(name), F.lit(False)
        has = lambda parts: F.greatest(none, *[low.contains(x) for x in parts])
        return F.when(has(self.phi), "phi_token").when(has(self.pii), "pii_hash").otherwise("none")

    def expression(self, value: Column, strategy: str) -> Column:
        if strategy == "pii_hash":
            return sha256_hex(F.concat(F.lit(self.salt), value.cast("string")) if self.salt else value)
        if strategy == "phi_token":
            if not self.key:
                raise ValueError("health fields need a key")
            return hmac_sha256_hex(value, self.key)
        return value


def mask(df: DataFrame, rules: Rules, columns: list[str] | None = None) -> DataFrame:
    """The columns whose names are classified, as digests; with `columns`, only those are looked at."""
    return df.select([rules.expression(F.col(c), rules.classify(c)).alias(c) if columns is None or c in columns else F.col(c) for c in df.columns])


def mask_cells(cells: Column, rules: Rules) -> Column:
    """A map of cells, each masked by its name."""
    by_name = lambda k, v: F.when(rules.classified(k) == "pii_hash", rules.expression(v, "pii_hash")).when(rules.classified(k) == "phi_token", rules.expression(v, "phi_token") if rules.key else F.raise_error(F.lit("health fields need a key")).cast("string")).otherwise(v)
    return F.transform_values(cells, by_name)


def audit(df: DataFrame, rules: Rules, identity: list[str]) -> DataFrame:
    """A row for each masked field of each row: identity, field, classification, strategy."""
    found = [(c, s) for c in df.columns if (s := rules.classify(c)) != "none"]
    kinds = {"pii_hash": ("PII", "HASH"), "phi_token": ("PHI", "HMAC")}
    if not found:
        return df.select(*identity, F.lit("").alias("field"), F.lit("").alias("classification"), F.lit("").alias("strategy")).limit(0)
    items = F.array(*[F.struct(F.lit(c).alias("field"), F.lit(kinds[s][0]).alias("classification"), F.lit(kinds[s][1]).alias("strategy")) for c, s in found])
    return df.select(*identity, F.explode(items).alias("x")).select(*identity, "x.*")
