"""DuckDB oracle SQL for the SCD2 queries, written step-wise: each batch is
capture -> close (MERGE) -> insert (correlated max) -> delete (IN subquery)
as chained CTEs, so agreement with the single-pass Spark merge is a check of
the rewrite."""

from __future__ import annotations

from dataclasses import dataclass

from ledgerwatch.sources.testtables import RUN_TS, sql_source_snapshot

# Spelled out here, apart from the engine's own lists, so that a wrong key, tracked
# column or mapping there shows as a mismatch.
END_TS = "9999-01-01 00:00:00"
EPOCH_TS = "1900-01-01 00:00:00"


@dataclass(frozen=True)
class DimSpec:
    name: str
    key: str
    tracked: tuple[str, ...]
    times: tuple[str, ...]  # timestamps; all other business columns are strings

    @property
    def business(self) -> tuple[str, ...]:
        return (self.key, *self.tracked)

    @property
    def types(self) -> dict:
        return {c: "timestamp_ntz" if c in self.times else "string" for c in self.business}


DIMENSIONS = {
    "terminals": DimSpec("terminals", "terminal_id", ("terminal_type", "terminal_city", "terminal_address"), ()),
    "cards": DimSpec("cards", "card_num", ("account_num",), ()),
    "accounts": DimSpec("accounts", "account_num", ("valid_to", "client"), ("valid_to",)),
    "clients": DimSpec("clients", "client_id",
                       ("last_name", "first_name", "patronymic", "date_of_birth", "passport_num", "passport_valid_to", "phone"),
                       ("date_of_birth", "passport_valid_to")),
}
# Target column -> source column.
SOURCE_COLUMNS = {
    "terminals": {c: c for c in ("terminal_id", "terminal_type", "terminal_city", "terminal_address")},
    "cards": {"card_num": "card_num", "account_num": "account"},
    "accounts": {"account_num": "account", "valid_to": "valid_to", "client": "client"},
    "clients": {c: c for c in ("client_id", "last_name", "first_name", "patronymic", "date_of_birth", "passport_num",
                               "passport_valid_to", "phone")},
}
FILE_DIMENSIONS = {"terminals"}

END = f"TIMESTAMP '{END_TS}'"


def _diff(spec: DimSpec) -> str:
    parts = [f"(s.{c} <> t.{c}) OR (s.{c} IS NULL AND t.{c} IS NOT NULL) "
             f"OR (s.{c} IS NOT NULL AND t.{c} IS NULL)" for c in spec.tracked]
    return "(" + " OR ".join(parts) + ")"


def _clean(spec: DimSpec, target: str, source: str) -> str:
    if spec.types[target] == "string":
        return f"nullif(trim({source}), '') AS {target}"
    return f"{source} AS {target}"


def _empty(spec: DimSpec) -> str:
    cols = ", ".join(
        f"CAST(NULL AS {'VARCHAR' if spec.types[c] == 'string' else 'TIMESTAMP'}) AS {c}"
        for c in spec.business)
    return (f"SELECT {cols}, CAST(NULL AS VARCHAR) AS deleted_flg, "
            f"CAST(NULL AS TIMESTAMP) AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to WHERE FALSE")


def stage_sql(spec: DimSpec, src: str, wm: str, run_ts: str) -> str:
    mapping = SOURCE_COLUMNS[spec.name]
    cols = ", ".join(_clean(spec, t, s) for t, s in mapping.items())
    if spec.name in FILE_DIMENSIONS:
        return (f"SELECT {cols}, update_dt FROM (SELECT *, TIMESTAMP '{run_ts}' AS update_dt FROM {src}) r "
                f"WHERE update_dt > {wm} OR update_dt IS NULL")
    return (f"SELECT {cols}, create_dt, CASE WHEN update_dt IS NULL THEN create_dt "
            f"ELSE TIMESTAMP '{run_ts}' END AS update_dt FROM {src} "
            f"WHERE update_dt > {wm} OR update_dt IS NULL")


def chain(spec: DimSpec, days: int, last_partial: str | None = None) -> list[tuple[str, str]]:
    """CTEs (name, sql) building h0..h{days-1}. With ``last_partial`` the
    final day stops after that step ('stage', 'close', 'insert')."""
    k = spec.key
    biz = ", ".join(spec.business)
    biz_s = ", ".join(f"s.{c}" for c in spec.business)
    key_src = SOURCE_COLUMNS[spec.name][k]
    ctes = [("h_init", _empty(spec))]
    prev = "h_init"
    for d in range(days):
        run = f"TIMESTAMP '{RUN_TS[d]}'"
        cut = f"({run} - INTERVAL 1 SECOND)"
        wm = f"(SELECT coalesce(max(effective_from), TIMESTAMP '{EPOCH_TS}') FROM {prev})"
        ctes.append((f"src{d}", sql_source_snapshot(spec.name, d)))
        ctes.append((f"stg{d}", stage_sql(spec, f"src{d}", wm, RUN_TS[d])))
        ctes.append((f"keys{d}", f"SELECT nullif(trim({key_src}), '') AS k FROM src{d}"))
        if last_partial == "stage" and d == days - 1:
            break
        ctes.append((f"chg{d}", f"""
SELECT s.{k} FROM stg{d} s LEFT JOIN {prev} t
  ON s.{k} = t.{k} AND t.effective_to = {END} AND t.deleted_flg = 'n'
WHERE t.{k} IS NULL OR (t.{k} IS NOT NULL AND {_diff(spec)})"""))
        ctes.append((f"ha{d}", f"""
SELECT {biz}, deleted_flg, effective_from,
       CASE WHEN {k} IN (SELECT {k} FROM chg{d}) AND effective_to = {END} THEN {cut}
            ELSE effective_to END AS effective_to
FROM {prev}"""))
        if last_partial == "close" and d == days - 1:
            break
        ctes.append((f"ins{d}", f"""
SELECT {biz_s}, 'n' AS deleted_flg, {run} AS effective_from, {END} AS effective_to
FROM stg{d} s LEFT JOIN ha{d} t ON s.{k} = t.{k}
WHERE t.{k} IS NULL
   OR (t.{k} IS NOT NULL AND {_diff(spec)}
       AND t.effective_to <> {END}
       AND t.effective_to = (SELECT max(effective_to) FROM ha{d} t1 WHERE t1.{k} = t.{k}))"""))
        ctes.append((f"hb{d}", f"SELECT * FROM ha{d} UNION ALL SELECT * FROM ins{d}"))
        if last_partial == "insert" and d == days - 1:
            break
        ctes.append((f"dk{d}", f"SELECT t.{k} FROM hb{d} t LEFT JOIN keys{d} s ON t.{k} = s.k WHERE s.k IS NULL"))
        ctes.append((f"h{d}", f"""
SELECT {biz},
       CASE WHEN del THEN 'y' ELSE deleted_flg END AS deleted_flg, effective_from,
       CASE WHEN del THEN {cut} ELSE effective_to END AS effective_to
FROM (SELECT *, coalesce({k} IN (SELECT {k} FROM dk{d}) AND deleted_flg = 'n'
                         AND effective_to = {END}, FALSE) AS del FROM hb{d}) x"""))
        prev = f"h{d}"
    return ctes


def with_chain(ctes: list[tuple[str, str]]) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s}\n)" for n, s in ctes) + "\n"


def render_cols(spec: DimSpec, src: str = "") -> str:
    p = f"{src}." if src else ""
    biz = ", ".join(f"{p}{c}" for c in spec.business)
    return (f"{biz}, {p}deleted_flg, strftime({p}effective_from, '%Y-%m-%d %H:%M:%S') AS effective_from, "
            f"strftime({p}effective_to, '%Y-%m-%d %H:%M:%S') AS effective_to")


def full(entity: str) -> str:
    spec = DIMENSIONS[entity]
    return with_chain(chain(spec, 3)) + f"SELECT {render_cols(spec)} FROM h2"


CL = DIMENSIONS["clients"]
TE = DIMENSIONS["terminals"]


def _sub_ops() -> dict[str, str]:
    k = CL.key
    out = {}
    base = chain(CL, 2)
    out["dim_current"] = with_chain(base) + (
        f"SELECT {render_cols(CL)} FROM h1 WHERE effective_to = {END} AND deleted_flg = 'n'")
    out["dim_latest_version"] = with_chain(base) + (
        f"SELECT {render_cols(CL, 't')} FROM h1 t WHERE t.{k} IS NOT NULL AND t.effective_to = "
        f"(SELECT max(effective_to) FROM h1 t1 WHERE t1.{k} = t.{k})")
    c3 = chain(CL, 3, last_partial="close")
    biz_s = ", ".join(f"s.{c}" for c in CL.business)
    out["scd2_changes"] = with_chain(c3) + f"""
SELECT {biz_s}, CASE WHEN t.{k} IS NULL THEN 'insert' ELSE 'update' END AS change_kind
FROM stg2 s LEFT JOIN h1 t ON s.{k} = t.{k} AND t.effective_to = {END} AND t.deleted_flg = 'n'
WHERE t.{k} IS NULL OR (t.{k} IS NOT NULL AND {_diff(CL)})"""
    out["scd2_close"] = with_chain(c3) + f"SELECT {render_cols(CL)} FROM ha2"
    c3i = chain(CL, 3, last_partial="insert")
    out["scd2_new_versions"] = with_chain(c3i) + f"SELECT {render_cols(CL)} FROM ins2"
    out["scd2_deletes"] = with_chain(chain(CL, 2)) + (
        f"SELECT {render_cols(CL)} FROM h1 WHERE deleted_flg = 'y' "
        f"AND effective_to = TIMESTAMP '{RUN_TS[1]}' - INTERVAL 1 SECOND")
    out["cap_watermark_or_null"] = with_chain(chain(CL, 2, last_partial="stage")) + (
        f"SELECT * FROM src1 WHERE update_dt > (SELECT coalesce(max(effective_from), "
        f"TIMESTAMP '{EPOCH_TS}') FROM h0) OR update_dt IS NULL")
    for ent in ("clients", "accounts", "cards", "terminals"):
        spec = DIMENSIONS[ent]
        cols = ", ".join(list(SOURCE_COLUMNS[ent]) + (["update_dt"] if ent in FILE_DIMENSIONS
                                                      else ["create_dt", "update_dt"]))
        out[f"stage_{ent}"] = with_chain(chain(spec, 2, last_partial="stage")) + f"SELECT {cols} FROM stg1"
    out["hist_ordered"] = with_chain(chain(TE, 3)) + (
        f"SELECT {render_cols(TE)} FROM h2 ORDER BY terminal_id, effective_from")
    # Counts per entity after day 2: source rows, history rows, open rows.
    parts = []
    # Prefix every CTE reference per entity.
    prefixed = []
    for ent in ("clients", "accounts", "cards", "terminals"):
        spec = DIMENSIONS[ent]
        names = [n for n, _ in chain(spec, 3)]
        for n, s in chain(spec, 3):
            body = s
            for other in sorted(names, key=len, reverse=True):
                body = _replace_ident(body, other, f"{ent}_{other}")
            prefixed.append((f"{ent}_{n}", body))
        parts.append(f"SELECT '{ent}' AS entity, (SELECT count(*) FROM {ent}_src2) AS source_rows, "
                     f"(SELECT count(*) FROM {ent}_h2) AS history_rows, "
                     f"(SELECT count(*) FROM {ent}_h2 WHERE effective_to = {END} AND deleted_flg = 'n') "
                     f"AS open_rows, (SELECT count(*) FROM {ent}_h2 WHERE deleted_flg = 'y') AS deleted_rows")
    out["reconcile_counts"] = with_chain(prefixed) + "\nUNION ALL\n".join(parts)
    # Source and open versions matched by key, column by column.
    found = []
    for ent in ("clients", "accounts", "cards", "terminals"):
        spec = DIMENSIONS[ent]
        cols = ", ".join(_clean(spec, t, s) for t, s in SOURCE_COLUMNS[ent].items())
        found.append(f"""
SELECT '{ent}' AS entity, coalesce(s.{spec.key}, t.{spec.key}) AS key,
       CASE WHEN t.{spec.key} IS NULL THEN 'missing' WHEN s.{spec.key} IS NULL THEN 'extra' ELSE 'differs' END AS kind
FROM (SELECT {cols} FROM {ent}_src2) s
FULL JOIN (SELECT * FROM {ent}_h1 WHERE effective_to = {END} AND deleted_flg = 'n') t ON s.{spec.key} = t.{spec.key}
WHERE coalesce(s.{spec.key}, t.{spec.key}) IS NOT NULL
  AND (s.{spec.key} IS NULL OR t.{spec.key} IS NULL OR {_diff(spec)})""")
    out["reconcile_content"] = with_chain(prefixed) + "\nUNION ALL\n".join(found)
    out["scd2_vanished_keys"] = with_chain(chain(CL, 2)) + (
        f"SELECT {k} FROM h0 WHERE effective_to = {END} AND deleted_flg = 'n' AND {k} IS NOT NULL "
        f"AND {k} NOT IN (SELECT k FROM keys1 WHERE k IS NOT NULL)")
    wm_parts = []
    for ent in ("clients", "accounts", "cards", "terminals"):
        wm_parts.append(f"SELECT 'dwh' AS table_db, 'dim_{ent}_hist' AS table_name, "
                        f"(SELECT coalesce(max(effective_from), TIMESTAMP '{EPOCH_TS}') FROM {ent}_h2) "
                        f"AS last_update_dt")
    out["wm_advance_dim"] = with_chain(prefixed) + "\nUNION ALL\n".join(wm_parts)
    return out


def _replace_ident(sql: str, name: str, new: str) -> str:
    import re
    return re.sub(rf"(?<![A-Za-z0-9_]){re.escape(name)}(?![A-Za-z0-9_])", new, sql)


SCD2_SQL = {f"scd2_full_{e}": full(e) for e in ("terminals", "accounts", "cards", "clients")}
SCD2_SQL.update(_sub_ops())
