"""Run parameters: one immutable value passed to the operators that need it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime

from corpus_health import constants as c


@dataclass(frozen=True)
class Params:
    """Dates, thresholds and lists of one analysis.

    The lists are configuration, so they become array literals in the plan;
    data that grows with the estate always arrives as a DataFrame instead.
    """

    migrated_at: datetime
    as_of: datetime | None = None
    inactive_years: int = 2
    refresh_days: int = 7
    activity_days: int = 90
    main_gb: float = 10.0
    mid_gb: float = 1.0
    large_mb: int = 100
    root_url: str = ""
    legacy_label: str = c.LEGACY_LABEL
    legacy_templates: tuple[str, ...] = tuple(c.LEGACY_TEMPLATES)
    legacy_prefixes: tuple[str, ...] = ()
    excluded_ids: tuple[str, ...] = ()
    channel_prefixes: tuple[str, ...] = ()
    name_patterns: tuple[str, ...] = ()
    junk_folders: tuple[str, ...] = tuple(c.JUNK_FOLDERS)
    binary_exts: tuple[str, ...] = ()
    weights: Mapping[str, float] = field(default_factory=lambda: dict(c.WEIGHTS))
    # reports named in the configuration, in its order: site, artifact, destination
    priority_reports: tuple[tuple[str, str, str], ...] = ()
    # rows of the limited lists of a site report; each list's total is reported beside it
    report_users: int = 20
    report_folders: int = 20
    report_exts: int = 15
    report_duplicates: int = 15
    report_large: int = 20
    report_post: int = 50

    def __post_init__(self) -> None:
        check_weights(self.weights)

    @property
    def today(self) -> datetime:
        """The day that ages are counted to; a batch names it, so that a repeated job gives the same."""
        if self.as_of is None:
            raise ValueError("Params.as_of is not set: ages and activity need the day they are counted to")
        return self.as_of

    def with_(self, **changes) -> "Params":
        return replace(self, **changes)

    @classmethod
    def from_config(cls, config: Mapping, as_of: datetime | None = None) -> "Params":
        """Build from a parsed client configuration; raises on missing or bad fields.

        A setting that is absent or null has its default; 0 stays 0, for every number.
        """
        client = config.get("cliente") or {}
        for name in ("nombre", "tenant_prefix", "carpeta_local"):
            if not client.get(name):
                raise ValueError(f"missing required setting: cliente.{name}")
        dates = config.get("fechas") or {}
        sizes = config.get("clasificacion") or {}
        legacy = config.get("sitios_legacy") or {}
        try:
            migrated_at = datetime.strptime(dates.get("migracion", "2000-01-01"), "%Y-%m-%d")
        except ValueError as e:
            raise ValueError("fechas.migracion must be YYYY-MM-DD") from e
        return cls(
            migrated_at=migrated_at,
            as_of=as_of,
            inactive_years=int(_given(dates, "inactividad_anios", 2)),
            refresh_days=int(_given(config.get("refresh") or {}, "dias_umbral", 7)),
            main_gb=float(_given(sizes, "gb_principal", 10.0)),
            mid_gb=float(_given(sizes, "gb_mediano", 1.0)),
            large_mb=int(_given(sizes, "mb_archivo_grande", 100)),
            root_url=client.get("sharepoint_url", ""),
            legacy_label=legacy.get("label") or c.LEGACY_LABEL,
            legacy_templates=tuple(legacy.get("templates") or c.LEGACY_TEMPLATES),
            legacy_prefixes=tuple(legacy.get("prefijos") or ()),
            excluded_ids=tuple(site["id"] for site in config.get("sitios_excluidos") or ()),
            channel_prefixes=tuple(config.get("canales_excluidos") or ()),
            priority_reports=tuple(
                (p.get("sitio", ""), p.get("archivo_html", ""), p.get("destino", ""))
                for p in config.get("informes_prioritarios") or ()
            ),
        )


def _given(settings: Mapping, name: str, default):
    value = settings.get(name)
    return default if value is None else value


def check_weights(weights: Mapping[str, float]) -> None:
    """A weight profile names all six dimensions and sums to one."""
    if set(weights) != set(c.WEIGHTS):
        raise ValueError(f"weights must name exactly {sorted(c.WEIGHTS)}")
    if abs(sum(weights.values()) - 1) > 1e-9:
        raise ValueError("weights must sum to 1")
