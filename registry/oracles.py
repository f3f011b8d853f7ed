"""SQL that must give the same rows as the queries, written independently of the operators."""

from __future__ import annotations

from assaysift.sources.vocab import FIELD_ALIASES, FIELD_BOUNDS, RECOMMENDED_FIELDS

from .inputs import BASE, PADDED, RAW, raw_header_case

CANON = {canonical: text for canonical, text in RAW.values()}
NUMBERS = [c for c in CANON if c in FIELD_BOUNDS]
K = "k, p, s, n, e"
NOTE = (
    "case n % 4 when 0 then concat('see', chr(10), 'Table ', p, chr(10), chr(10), ', \"', s, '\" below') "
    "when 1 then concat('a, b', chr(13), chr(10), 'c ', k) when 2 then concat('\"', q, '\"') else 'plain' end"
)
KC = "k, p, s, n, e, copy"

# Fixed values, not taken from the library: what the header checks cut off.
UNIT_WORDS = (
    "m2/g", "cm2/g", "cm3/g", "mg/cm2", "g/cm3", "mah/g", "f/g", "a/g", "ma/g",
    "nm", "a", "angstrom", "um", "at%", "wt%", "%", "c", "v", "mv/s",
)
REMARK_WORDS = ("unit", "units", "value", "reported", "from", "source")

NUM = r"try_cast(nullif(regexp_extract(replace({c}, ',', ''), '[-+]?\d*\.?\d+(?:[eE][-+]?\d+)?'), '') AS double)"
TEXT = "coalesce(translate(lower({c}), '−⁻²³·μ', '--23 µ'), '')"
STRIP = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
MISSING = "({c} IS NULL OR lower(" + STRIP + ") IN ('', 'nan', 'none', 'null', 'n/a', 'na', '-'))"
NORM = "CASE WHEN " + MISSING + r" THEN '' ELSE regexp_replace(lower(" + STRIP + r"), '\s+', ' ', 'g') END"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _raw() -> str:
    columns = ", ".join(f'{text} AS "{c}"' for c, text in CANON.items())
    return f"base AS (SELECT {BASE} FROM lineitem), padded AS (SELECT *, {PADDED} FROM base), raw AS (SELECT {K}, {columns} FROM padded)"


def _raw_copies() -> str:
    names = [c for c in CANON if c != "BET_m2_g"]
    restated = "CASE WHEN p % 4 = 0 THEN concat(cast(regexp_extract(\"BET_m2_g\", '[0-9]+') AS int) * 10000, ' cm²/g') ELSE \"BET_m2_g\" END"
    listed = ", ".join(f'"{c}"' for c in names)
    return _raw() + (
        f', rawc AS (SELECT {K}, 0 AS copy, {listed}, "BET_m2_g" FROM raw UNION ALL '
        f'SELECT {K}, 1 AS copy, {listed}, {restated} AS "BET_m2_g" FROM raw WHERE p % 50 = 0)'
    )


def _rule(field: str) -> str:
    """Name of the conversion of a field, or null; x_ is the number, t_ the unit text."""
    t, x = f't_{field}', f"x_{field}"
    t0 = rf"regexp_replace({t}, '\s+', '', 'g')"
    rules = {
        "carbonization_temperature_C": [("kelvin", rf"regexp_matches({t}, '(^|\s)\d*\.?\d+\s*k(\s|$)') OR contains({t}, ' kelvin')")],
        "d002_nm": [
            ("angstrom", rf"regexp_matches({t}, 'å|angstrom|angström') OR regexp_matches({t}, '(^|\s)\d*\.?\d+\s*a(\s|$)')"),
            ("bare_angstrom", f"{x} BETWEEN 2.5::double AND 5.0::double AND NOT regexp_matches({t}, 'nm|å|angstrom|angström')"),
        ],
        "BET_m2_g": [("cm2_per_g", rf"regexp_matches({t0}, 'cm2/g|cm\^2/g|cm2g')")],
        "current_density_A_g": [("ma_per_g", f"regexp_matches({t0}, 'ma/g|mag')")],
        "capacity_mAh_g": [("ah_per_g", rf"regexp_matches({t}, '(^|[^m])ah\s*/?\s*g')")],
        "mass_loading_mg_cm2": [("g_per_m2", f"regexp_matches({t0}, 'g/m2|gm-2|gm2')")],
    }
    if field in ("XPS_N_at_pct", "XPS_O_at_pct", "ICE_pct"):
        rules[field] = [("percent_scale", f"{x} > 0 AND {x} <= 1 AND contains({t}, '%')")]
    if field not in rules:
        return "NULL"
    arms = " ".join(f"WHEN {x} IS NOT NULL AND ({cond}) THEN '{name}'" for name, cond in rules[field])
    return f"CASE {arms} END"


CONVERT = {
    "kelvin": "{x} - 273.15::double", "angstrom": "{x} / 10.0::double", "bare_angstrom": "{x} / 10.0::double",
    "cm2_per_g": "{x} / 10000.0::double", "ma_per_g": "{x} / 1000.0::double", "ah_per_g": "{x} * 1000.0::double",
    "g_per_m2": "{x} * 0.1::double", "percent_scale": "{x} * 100.0::double",
}
KIND = {
    "bare_angstrom": ("possible_unit_conversion", "medium"), "percent_scale": ("possible_percent_scale", "medium"),
}
TRACED = [f for f in NUMBERS if _rule(f) != "NULL"]


def _value(field: str) -> str:
    if field not in TRACED:
        return f"x_{field}"
    arms = " ".join(f"WHEN '{name}' THEN {expr.format(x='x_' + field)}" for name, expr in CONVERT.items())
    return f"CASE r_{field} {arms} ELSE x_{field} END"


def _clean(keys: str = K) -> str:
    source = "raw" if keys == K else "rawc"
    parsed = ", ".join(f'{NUM.format(c=chr(34) + f + chr(34))} AS x_{f}, {TEXT.format(c=chr(34) + f + chr(34))} AS t_{f}' for f in NUMBERS)
    coded = ", ".join(f"{_rule(f)} AS r_{f}" for f in TRACED)
    out = ", ".join(f'{_value(c)} AS "{c}"' if c in NUMBERS else f'"{c}"' for c in CANON)
    trace = ", ".join(f'r_{f}, "{f}" AS o_{f}' for f in TRACED)
    return (
        (_raw() if keys == K else _raw_copies())
        + f", parsed AS (SELECT *, {parsed} FROM {source}), coded AS (SELECT *, {coded} FROM parsed)"
        + f", norm AS (SELECT {keys}, {out}, {trace} FROM coded)"
    )


def _log() -> str:
    parts = []
    for f in TRACED:
        kind = " ".join(f"WHEN '{n}' THEN '{v[0]}'" for n, v in KIND.items())
        sure = " ".join(f"WHEN '{n}' THEN '{v[1]}'" for n, v in KIND.items())
        parts.append(
            f"SELECT {K}, coalesce(paper_id, '') AS paper_id, coalesce(sample_id, '') AS sample_id, '{f}' AS field, "
            f'o_{f} AS original_value, "{f}" AS cleaned_value, CASE r_{f} {kind} ELSE \'unit_conversion\' END AS correction_type, '
            f"CASE r_{f} {sure} ELSE 'high' END AS confidence, {NUMBERS.index(f)} AS field_pos FROM norm WHERE r_{f} IS NOT NULL"
        )
    return "log AS (" + " UNION ALL ".join(parts) + ")"


def _outliers() -> str:
    """Medians and deviations by the ranks of all values."""
    norm_paper = NORM.format(c="paper_id")
    ids = ", ".join(f"CASE WHEN {MISSING.format(c=c)} THEN '' ELSE {c} END AS {c}" for c in ("paper_id", "sample_id"))
    cells = " UNION ALL ".join(
        f"SELECT {K}, {norm_paper} AS paper_key, {ids}, {i} AS field_pos, "
        f"'{f}' AS field, \"{f}\" AS v FROM norm"
        for i, f in ((FIELDS.index(f), f) for f in NUMBERS)
    )
    middle = lambda v: f"(min({v}) FILTER (r = (sz - 1) // 2) + min({v}) FILTER (r = sz // 2)) / 2.0::double"
    return (
        f"cells AS (SELECT * FROM ({cells}) WHERE paper_key <> '' AND v IS NOT NULL), "
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY paper_key, field ORDER BY v) - 1 AS r, count(*) OVER (PARTITION BY paper_key, field) AS sz FROM cells), "
        f"medians AS (SELECT paper_key, field, sz, {middle('v')} AS median FROM ranked GROUP BY paper_key, field, sz HAVING sz >= 5), "
        "apart AS (SELECT cells.*, sz, abs(v - median) AS apart FROM cells JOIN medians USING (paper_key, field)), "
        "ranked_apart AS (SELECT paper_key, field, sz, apart, row_number() OVER (PARTITION BY paper_key, field ORDER BY apart) - 1 AS r FROM apart), "
        f"spreads AS (SELECT paper_key, field, {middle('apart')} AS spread FROM ranked_apart GROUP BY paper_key, field, sz)"
    )


# Units in the texts of the tables: dimension over m, kg, s, A, K, mol and the power of ten of one unit.
UNITS = {
    "m2/g": ("2 -1 0 0 0 0", 3.0), "cm2/g": ("2 -1 0 0 0 0", -1.0), "°c": ("0 0 0 0 1 0", 0.0), "k": ("0 0 0 0 1 0", 0.0), "å": ("1 0 0 0 0 0", -10.0),
    "nm": ("1 0 0 0 0 0", -9.0), "at%": ("0 0 0 0 0 0", -2.0), "%": ("0 0 0 0 0 0", -2.0), "cm3/g": ("3 -1 0 0 0 0", -3.0), "g/m2": ("-2 1 0 0 0 0", -3.0),
    "mg/cm2": ("-2 1 0 0 0 0", -2.0), "mg cm-2": ("-2 1 0 0 0 0", -2.0), "mah/g": ("0 -1 1 1 0 0", 3.556302501), "ah/g": ("0 -1 1 1 0 0", 6.556302501),
    "f g-1": ("-2 -2 4 2 0 0", 3.0), "f/g": ("-2 -2 4 2 0 0", 3.0), "ma g-1": ("0 -1 0 1 0 0", 0.0), "a/g": ("0 -1 0 1 0 0", 3.0),
    "c g^-1": ("0 -1 1 1 0 0", 3.0), "m2 g-1": ("2 -1 0 0 0 0", 3.0), "m2/cm3": ("-1 0 0 0 0 0", 6.0), "bits/g": (None, None),
}
FITTING = {
    "carbonization_temperature_C": "0 0 0 0 1 0", "BET_m2_g": "2 -1 0 0 0 0", "d002_nm": "1 0 0 0 0 0", "ID_IG": "0 0 0 0 0 0", "XPS_N_at_pct": "0 0 0 0 0 0",
    "XPS_O_at_pct": "0 0 0 0 0 0", "pore_volume_cm3_g": "3 -1 0 0 0 0", "mass_loading_mg_cm2": "-2 1 0 0 0 0", "ICE_pct": "0 0 0 0 0 0",
    "capacity_mAh_g": "0 -1 1 1 0 0", "capacitance_F_g": "-2 -2 4 2 0 0", "current_density_A_g": "0 -1 0 1 0 0",
}
FIELDS = (
    "carbonization_temperature_C", "BET_m2_g", "d002_nm", "ID_IG", "XPS_N_at_pct", "XPS_O_at_pct", "pore_volume_cm3_g", "micropore_volume_cm3_g",
    "mass_loading_mg_cm2", "electrode_thickness_um", "compacted_density_g_cm3", "ICE_pct", "capacity_mAh_g", "capacitance_F_g", "current_density_A_g",
)


def _unit_cells() -> str:
    """Cells with their unit: what is left of the folded text behind its leading amounts."""
    misfit = {
        "capacity_mAh_g": "case when p % 7 = 0 then concat(q, ' F/g') when p % 11 = 0 then concat(q, ' bits/g') when p % 13 = 0 then concat(q, ' C g^-1') "
        'else "capacity_mAh_g" end',
        "BET_m2_g": "case when s % 7 = 0 then concat(q, '±', n, ' m²·g⁻1') when s % 9 = 0 then concat(q, ' m2/cm3') else \"BET_m2_g\" end",
        "ID_IG": "case when n = 3 then concat(\"ID_IG\", ' nm') else \"ID_IG\" end",
    }
    columns = ", ".join(f'{text} AS "{c}"' for c, text in CANON.items())
    cells = " UNION ALL ".join(
        f"SELECT {K}, CASE WHEN {MISSING.format(c='paper_id')} THEN '' ELSE paper_id END AS paper_id, "
        f"CASE WHEN {MISSING.format(c='sample_id')} THEN '' ELSE sample_id END AS sample_id, {FIELDS.index(f)} AS field_pos, '{f}' AS field, "
        f"'{FITTING[f]}' AS expected, {misfit.get(f, chr(34) + f + chr(34))} AS value FROM raw"
        for f in FITTING
    )
    folded = TEXT.format(c="value")
    unit = rf"trim(regexp_replace({folded}, '^[-+]?[0-9][0-9.,]*(±[0-9]+)?', ''))"
    unit = f"CASE WHEN {unit} = 'c' THEN '°c' WHEN {unit} = 'a' AND field = 'd002_nm' THEN 'å' ELSE {unit} END"
    known = ", ".join(f"('{u}', {'NULL' if d is None else repr(d)}, {'NULL' if x is None else x}::double)" for u, (d, x) in UNITS.items())
    return (
        f"base AS (SELECT {BASE} FROM lineitem), padded AS (SELECT *, {PADDED} FROM base), raw AS (SELECT {K}, q, {columns} FROM padded), "
        f"cells AS (SELECT *, {unit} AS unit FROM ({cells}) WHERE regexp_matches(value, '[0-9]')), "
        f"known(unit, dimension, log_factor) AS (VALUES {known})"
    )


def _bound_case(field: str) -> str:
    b = FIELD_BOUNDS[field]
    arms = []
    for limit, sign, code in (("hard_min", "<", "below_hard_min"), ("hard_max", ">", "above_hard_max"),
                              ("soft_min", "<", "below_soft_min"), ("soft_max", ">", "above_soft_max")):
        bound = getattr(b, limit)
        if bound is not None:
            arms.append(f'WHEN "{field}" {sign} {bound}::double THEN \'{code}\'')
    return "CASE " + " ".join(arms) + " END"


def _physics() -> str:
    blank = {c: f"CASE WHEN {MISSING.format(c=c)} THEN '' ELSE {c} END" for c in ("paper_id", "sample_id")}
    ids = f"{blank['paper_id']} AS paper_id, {blank['sample_id']} AS sample_id"
    parts = []
    for i, f in enumerate(FIELD_BOUNDS):
        if f in NUMBERS:
            parts.append(
                f"SELECT {K}, paper_id, sample_id, '{f}' AS field, CASE WHEN code LIKE '%hard%' THEN 'P0' ELSE 'P1' END AS risk_level, "
                f'code AS rule_code, v AS value_num, {i} AS flag_seq FROM (SELECT {K}, {ids}, "{f}" AS v, {_bound_case(f)} AS code FROM norm) '
                "WHERE code IS NOT NULL"
            )
    gaps = [(f, 1000 + i, "missing_recommended", MISSING.format(c=f)) for i, f in enumerate(RECOMMENDED_FIELDS)]
    gaps += [("mass_loading_mg_cm2", 2000, "missing_engineering", "mass_loading_mg_cm2 IS NULL")]
    for f, seq, code, cond in gaps:
        parts.append(
            f"SELECT {K}, {ids}, '{f}' AS field, 'P2' AS risk_level, '{code}' AS rule_code, NULL::double AS value_num, {seq} AS flag_seq "
            f"FROM norm WHERE {cond}"
        )
    return "physics AS (" + " UNION ALL ".join(parts) + ")"


# Numbers that near-duplicates are compared by.
NEAR = ("BET_m2_g", "d002_nm", "ID_IG", "ICE_pct", "capacity_mAh_g", "capacitance_F_g", "current_density_A_g")


def _keyed(keys: str = K) -> str:
    norms = ", ".join(f"{NORM.format(c=c)} AS n_{c}" for c in ("paper_id", "sample_id", "sample_name"))
    texts = ", ".join(f"CASE WHEN \"{c}\" IS NOT NULL THEN '{c}=' || printf('%.6g', \"{c}\") END AS m_{c}" for c in NEAR)
    parts = ["CASE WHEN n_paper_id <> '' THEN 'paper_id=' || n_paper_id END", *[f"m_{c}" for c in NEAR]]
    filled = " + ".join(f"cast(({p}) IS NOT NULL AS int)" for p in parts)
    raw = "coalesce(paper_id, '') AS paper_id, coalesce(sample_id, '') AS sample_id, coalesce(sample_name, '') AS sample_name"
    return (
        f"normed AS (SELECT {keys}, {raw}, {norms}, {texts} FROM norm), "
        f"marked AS (SELECT *, concat_ws('||', {', '.join(parts)}) AS marker, {filled} AS filled FROM normed), "
        f"keyed AS (SELECT {keys}, paper_id, sample_id, sample_name, 1 AS detector, n_sample_id AS key, '' AS key2 FROM marked WHERE n_sample_id <> '' "
        f"UNION ALL SELECT {keys}, paper_id, sample_id, sample_name, 2, n_paper_id, n_sample_name FROM marked WHERE n_paper_id <> '' AND n_sample_name <> '' "
        f"UNION ALL SELECT {keys}, paper_id, sample_id, sample_name, 3, marker, '' FROM marked WHERE filled >= 4), "
        "hits AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY detector, key, key2) AS n_same FROM keyed) WHERE n_same > 1)"
    )


def _dups(keys: str = K) -> str:
    return (
        f"dups AS (SELECT {keys}, paper_id, sample_id, "
        "CASE detector WHEN 1 THEN 'sample_id' WHEN 2 THEN 'paper_id+sample_name' ELSE 'near_duplicate_values' END AS field, "
        "CASE detector WHEN 3 THEN 'P2' ELSE 'P1' END AS risk_level, "
        "CASE detector WHEN 1 THEN 'dup_sample_id' WHEN 2 THEN 'dup_paper_sample' ELSE 'near_duplicate' END AS rule_code, "
        "NULL::double AS value_num, 3000 + detector AS flag_seq, "
        "CASE detector WHEN 1 THEN sample_id WHEN 2 THEN paper_id || ' | ' || sample_name ELSE key END AS value FROM hits)"
    )


FLAG_OUT = "paper_id, sample_id, field, risk_level, rule_code, value_num, flag_seq"


def _flags() -> str:
    out = f"{K}, {FLAG_OUT}"
    return _with(_clean(), _physics(), _keyed(), _dups(), f"flags AS (SELECT {out} FROM physics UNION ALL SELECT {out} FROM dups)")


COUNTS = (
    "cast(count(*) FILTER (WHERE risk_level = 'P0') AS bigint) AS \"P0\", cast(count(*) FILTER (WHERE risk_level = 'P1') AS bigint) AS \"P1\", "
    "cast(count(*) FILTER (WHERE risk_level = 'P2') AS bigint) AS \"P2\""
)
SEVERITY = "CASE risk_level WHEN 'P0' THEN 0 WHEN 'P1' THEN 1 WHEN 'P2' THEN 2 ELSE 9 END"
DECISION = "CASE WHEN \"P0\" > 0 THEN 'NOT_READY' WHEN \"P1\" > 0 THEN 'REVIEW_NEEDED' ELSE 'PASS_WITH_NOTES' END"
FIELD_COUNTS = (
    "per_field AS (SELECT field, count(*) AS n, min(struct_pack(d := CASE WHEN flag_seq >= 3000 THEN flag_seq ELSE 0 END, k := k, p := p, "
    "s := s, n := n, e := e, q := flag_seq)) AS seen FROM flags GROUP BY field), "
    "fields AS (SELECT field, n, row_number() OVER (ORDER BY n DESC, seen) - 1 AS i FROM per_field QUALIFY i < 20)"
)
TYPE_COUNTS = (
    "types AS (SELECT correction_type, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, min(field_pos)) - 1 AS i "
    "FROM log GROUP BY correction_type)"
)
TOP = f"top AS (SELECT *, row_number() OVER (ORDER BY {SEVERITY}, {K}, flag_seq) - 1 AS i FROM flags QUALIFY i < 10)"


def _h(c: str) -> str:
    return f"trim(regexp_replace(translate(lower({c}), '²³⁻−·_', '23--  '), '[^a-z0-9%/+-]+', ' ', 'g'))"


def _no_unit(c: str) -> str:
    return f"regexp_replace({c}, '(?:(?:^| )(?:{'|'.join(UNIT_WORDS)}))+$', '')"


def _catalogue() -> str:
    parts = [
        f"SELECT o_orderkey AS table_id, {i} AS position, {raw_header_case(h, 'o_orderkey')} AS raw_header FROM orders"
        for i, h in enumerate(RAW)
    ]
    return "catalogue AS (" + " UNION ALL ".join(parts) + ")"


def _mapped(source: str, keys: str) -> str:
    """Header map of ``source``: distinct headers are spelled, matched and joined back."""
    rows = [
        f"({i}, '{name}', '{text}')" for i, (name, texts) in enumerate(FIELD_ALIASES.items()) for text in (name, *texts)
    ]
    remark = rf"regexp_replace(full_text, '\s+(?:{'|'.join(REMARK_WORDS)})\s+.*$', '')"
    bare = rf"regexp_replace(raw_header, '\([^)]*\)', ' ', 'g')"
    return (
        f"aliases(ord, canonical, spelling) AS (VALUES {', '.join(rows)}), "
        f"alias_dim AS (SELECT DISTINCT ord, canonical, {_no_unit(_h('spelling'))} AS alias FROM aliases), "
        f"distinct_headers AS (SELECT DISTINCT raw_header FROM {source}), "
        f"spelled AS (SELECT raw_header, {_h('raw_header')} AS full_text, {_h(bare)} AS bare_text FROM distinct_headers), "
        f"candidates AS (SELECT raw_header, unnest([full_text, bare_text, {_no_unit('full_text')}, {_no_unit('bare_text')}, {remark}]) AS alias FROM spelled), "
        "matched AS (SELECT raw_header, min_by(canonical, ord) AS canonical FROM candidates JOIN alias_dim USING (alias) "
        "WHERE alias <> '' GROUP BY raw_header), "
        f"mapped AS (SELECT {keys}, position, raw_header, canonical FROM {source} LEFT JOIN matched USING (raw_header))"
    )


def _headers() -> str:
    return _with(_catalogue(), _mapped("catalogue", "table_id"))


# Fields that every table should have.
EXPECTED = ("paper_id", "sample_id", "sample_name", "source_location")
DUP_TARGETS = (
    "dup_targets AS (SELECT table_id, canonical, count(*) AS n, string_agg(raw_header, ', ' ORDER BY position) AS raw_headers, "
    "string_agg(raw_header, ',' ORDER BY position) AS plain, min(position) AS first_at FROM mapped WHERE canonical IS NOT NULL "
    "GROUP BY table_id, canonical HAVING count(*) > 1)"
)
HEADER_COUNTS = (
    "header_counts AS (SELECT table_id, count(*) AS n_raw_columns, count(canonical) AS n_mapped_columns, "
    "count(*) - count(canonical) AS n_unknown_columns, string_agg(raw_header, '|' ORDER BY position) FILTER (WHERE canonical IS NULL) AS unknown_columns, "
    + ", ".join(f"bool_or(coalesce(canonical = '{f}', false)) AS has_{i}" for i, f in enumerate(EXPECTED))
    + " FROM mapped GROUP BY table_id)"
)
GAPS = "concat_ws('|', " + ", ".join(f"CASE WHEN NOT has_{i} THEN '{f}' END" for i, f in enumerate(EXPECTED)) + ")"


def _cells() -> str:
    parts = [
        f"SELECT {K}, {i} AS position, {raw_header_case(h, 'k')} AS raw_header, {text} AS raw_value FROM padded"
        for i, (h, (_, text)) in enumerate(RAW.items())
    ]
    return f"base AS (SELECT {BASE} FROM lineitem), padded AS (SELECT *, {PADDED} FROM base), cells AS (" + " UNION ALL ".join(parts) + ")"


def _spelled() -> str:
    """Names of a paper, and which of them reach which by single changes of a letter; each pair is compared."""
    spelled = (
        "case k % 7 when 0 then concat('Hard carbon ', p % 40) when 1 then concat('hard carbn ', p % 40) when 2 then concat('hardd  carbon ', p % 40) "
        "when 3 then concat('soft carbon ', p % 40) when 4 then concat('hord carbon ', p % 40) when 5 then 'n/a' else concat('HC', p % 4) end"
    )
    shown = ", ".join(f"CASE WHEN {MISSING.format(c=c)} THEN '' ELSE {c} END AS {c}" for c in ("paper_id", "sample_id", "sample_name"))
    digits = "trim(regexp_replace({c}.name_key, '[^0-9]+', ' ', 'g'))"
    return (
        f"WITH RECURSIVE base AS (SELECT {BASE} FROM lineitem), spelled AS (SELECT {K}, {CANON['paper_id']} AS paper_id, {CANON['sample_id']} AS sample_id, "
        f"{spelled} AS sample_name FROM base),\n"
        f"named AS (SELECT {K}, {NORM.format(c='paper_id')} AS paper_key, {NORM.format(c='sample_name')} AS name_key, {shown} FROM spelled),\n"
        "names AS (SELECT paper_key, name_key, count(*) AS n FROM named WHERE paper_key <> '' AND length(name_key) >= 4 GROUP BY ALL),\n"
        "links AS (SELECT a.paper_key, a.name_key AS a, b.name_key AS b FROM names a JOIN names b ON a.paper_key = b.paper_key AND a.name_key <> b.name_key "
        f"AND {digits.format(c='a')} = {digits.format(c='b')} AND levenshtein(a.name_key, b.name_key) <= 1),\n"
        "reach AS (SELECT paper_key, a, b FROM links UNION SELECT r.paper_key, r.a, l.b FROM reach r JOIN links l ON l.paper_key = r.paper_key AND l.a = r.b),\n"
        "classes AS (SELECT paper_key, a AS name_key, least(a, min(b)) AS component FROM reach GROUP BY paper_key, a),\n"
        "degrees AS (SELECT paper_key, a AS name_key, count(*) AS n_links FROM links GROUP BY ALL)\n"
    )


def _convert_sql(*fields: str) -> str:
    listed = ", ".join(f'"{f}" AS {f}_text, {_value(f)} AS {f}_value, r_{f} AS {f}_rule' for f in fields)
    return _with(_clean()) + f"SELECT {K}, {listed} FROM coded"


def _null_tokens(c: str) -> str:
    tokens = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
              "NULL", "NaN", "None", "n/a", "nan", "null")
    return f"CASE WHEN \"{c}\" NOT IN ({', '.join(repr(t) for t in tokens)}) THEN \"{c}\" END AS \"{c}\""


def oracle_sql() -> dict[str, str]:
    clean_columns = ", ".join(f'"{c}"' for c in CANON)
    log = _with(_clean(), _log())
    log_columns = f"{K}, paper_id, sample_id, field, original_value, cleaned_value, correction_type, confidence, field_pos"
    flags = _flags()
    flags_and_log = flags.rstrip() + ",\n" + _log()
    keyed = _with(_clean(), _keyed())
    keyed_copies = _with(_clean(KC), _keyed(KC))
    wide = ", ".join(
        f"max(CASE WHEN canonical = '{c}' AND rn = 1 THEN raw_value END) AS \"{c}\"" for c in FIELD_ALIASES
    )
    return {
        "parse_number": _with(_clean()) + f"SELECT {K}, " + ", ".join(f'x_{f} AS "{f}"' for f in NUMBERS) + " FROM parsed",
        "parse_number_documents": f"SELECT doc_id, {NUM.format(c='text')} AS first_number FROM documents",
        "unit_text": _with(_clean()) + f"SELECT {K}, " + ", ".join(f't_{f} AS "{f}"' for f in ("BET_m2_g", "d002_nm", "current_density_A_g", "ID_IG")) + " FROM parsed",
        "unit_text_documents": f"SELECT doc_id, md5({TEXT.format(c='text')}) AS unit_text_md5 FROM documents",
        "convert_kelvin": _convert_sql("carbonization_temperature_C"),
        "convert_angstrom": _convert_sql("d002_nm"),
        "convert_bet": _convert_sql("BET_m2_g"),
        "convert_current": _convert_sql("current_density_A_g"),
        "convert_capacity": _convert_sql("capacity_mAh_g"),
        "convert_loading": _convert_sql("mass_loading_mg_cm2"),
        "convert_percent": _convert_sql("XPS_N_at_pct", "XPS_O_at_pct", "ICE_pct"),
        "normalize_all": _with(_clean()) + f"SELECT {K}, {clean_columns} FROM norm",
        "corrections_log": log + f"SELECT {log_columns} FROM log",
        "corrections_preview": log + f"SELECT {log_columns} FROM log ORDER BY field_pos, {K} LIMIT 50",
        "unit_summary": log + f"SELECT (SELECT count(*) FROM norm) AS n_rows, {len(NUMBERS)} AS n_numeric_fields, count(*) AS n_corrections, "
        "count(*) FILTER (WHERE confidence = 'medium') AS n_medium_confidence_corrections FROM log",
        "correction_type_counts": log + "SELECT correction_type, count(*) AS n FROM log GROUP BY correction_type",
        "missing_mask": _with(_clean()) + f"SELECT {K}, " + ", ".join(f"{MISSING.format(c=c)} AS {c}" for c in ("paper_id", "sample_id", "sample_name", "source_location"))
        + ', "mass_loading_mg_cm2" IS NULL AS "mass_loading_mg_cm2", "ICE_pct" IS NULL AS "ICE_pct" FROM norm',
        "hard_bounds": _with(_clean(), _physics()) + f"SELECT {K}, field, value_num, cast(value_num AS varchar) AS value, rule_code FROM physics WHERE rule_code IN ('below_hard_min', 'above_hard_max')",
        "soft_bounds": _with(_clean(), _physics()) + f"SELECT {K}, field, value_num, cast(value_num AS varchar) AS value, rule_code FROM physics WHERE rule_code IN ('below_soft_min', 'above_soft_max')",
        "physics_flags": _with(_clean(), _physics()) + f"SELECT {K}, {FLAG_OUT} FROM physics",
        "physics_flags_rule_table": _with(_clean(), _physics()) + f"SELECT {K}, field, value_num, risk_level, rule_code, flag_seq FROM physics WHERE flag_seq < 1000",
        "norm_keys": keyed + f"SELECT {K}, detector, key, key2 FROM keyed",
        "dup_sample_id": keyed + f"SELECT {K}, key, key2 FROM hits WHERE detector = 1",
        "dup_paper_sample": keyed + f"SELECT {K}, key, key2 FROM hits WHERE detector = 2",
        "near_dup": keyed_copies + f"SELECT {KC}, key, key2 FROM hits WHERE detector = 3",
        "duplicate_flags": _with(_clean(KC), _keyed(KC), _dups(KC)) + f"SELECT {KC}, {FLAG_OUT}, value FROM dups",
        "name_classes": _spelled()
        + "SELECT paper_key, name_key, n, coalesce(component, name_key) AS component, coalesce(n_links, 0) AS n_links "
        + "FROM names LEFT JOIN classes USING (paper_key, name_key) LEFT JOIN degrees USING (paper_key, name_key)",
        "name_slips": _spelled()
        + f"SELECT {K}, paper_id, sample_id, 'sample_name' AS field, 'P2' AS risk_level, 'name_slip' AS rule_code, NULL::double AS value_num, 6000 AS flag_seq, "
        + "sample_name AS value FROM named JOIN classes USING (paper_key, name_key)",
        "all_flags": flags + f"SELECT {K}, {FLAG_OUT} FROM flags",
        "review_queue": flags + f"SELECT {K}, {FLAG_OUT}, row_number() OVER (ORDER BY {SEVERITY}, paper_id, sample_id, {K}, flag_seq) AS rank FROM flags",
        "flag_counts": flags + f"SELECT {COUNTS}, count(*) AS total FROM flags",
        "decision": flags + f"SELECT *, {DECISION} AS decision FROM (SELECT {COUNTS}, count(*) AS total FROM flags)",
        "paper_audit": flags + f"SELECT paper_id, {COUNTS}, count(*) AS total_flags FROM flags GROUP BY paper_id",
        "field_counts_top20": flags.rstrip() + ",\n" + FIELD_COUNTS + "\nSELECT field, n FROM fields",
        "top10_review": flags.rstrip() + ",\n" + TOP + f"\nSELECT {K}, {FLAG_OUT} FROM top",
        "header_normalize": _with(_catalogue()) + f"SELECT table_id, position, raw_header, {_h('raw_header')} AS header_text FROM catalogue",
        "header_candidates": _headers().rstrip() + ",\nlisted AS (SELECT raw_header, array_to_string(list_sort(list_distinct(list(alias))), '|') AS candidates "
        "FROM candidates WHERE alias <> '' GROUP BY raw_header)\n"
        "SELECT table_id, position, raw_header, candidates FROM catalogue JOIN listed USING (raw_header)",
        "header_map": _headers() + "SELECT table_id, position, raw_header, canonical FROM mapped",
        "unknown_headers": _headers() + "SELECT table_id, position, raw_header FROM mapped WHERE canonical IS NULL",
        "header_counts": _headers().rstrip() + f",\n{HEADER_COUNTS},\n{DUP_TARGETS}\n"
        "SELECT table_id, n_raw_columns, n_mapped_columns, n_unknown_columns, coalesce(d.n, 0) AS n_duplicate_canonical_mappings FROM header_counts "
        "LEFT JOIN (SELECT table_id, count(*) AS n FROM dup_targets GROUP BY table_id) d USING (table_id)",
        "duplicate_targets": _headers().rstrip() + f",\n{DUP_TARGETS}\nSELECT table_id, canonical, n, raw_headers FROM dup_targets",
        "missing_recommended": _headers().rstrip() + f",\n{HEADER_COUNTS}\n"
        + " UNION ALL ".join(f"SELECT table_id, '{f}' AS field FROM header_counts WHERE NOT has_{i}" for i, f in enumerate(EXPECTED)),
        "header_dedup_names": _headers() + "SELECT table_id, position, raw_header, canonical, CASE WHEN rn = 1 THEN name ELSE name || '__duplicate_' || (rn - 1) END AS target "
        "FROM (SELECT *, coalesce(canonical, raw_header) AS name, row_number() OVER (PARTITION BY table_id, coalesce(canonical, raw_header) ORDER BY position) AS rn FROM mapped)",
        "schema_state": _headers().rstrip() + f",\n{HEADER_COUNTS},\n{DUP_TARGETS},\n"
        "per_table AS (SELECT table_id, count(*) AS n, string_agg(canonical || '=' || plain, '|' ORDER BY first_at) AS listed FROM dup_targets GROUP BY table_id)\n"
        "SELECT table_id, n_raw_columns, n_mapped_columns, n_unknown_columns, coalesce(n, 0) AS n_duplicate_canonical_mappings, "
        f"coalesce(unknown_columns, '') AS unknown_columns, coalesce(listed, '') AS duplicate_mappings, {GAPS} AS missing_fields, "
        "coalesce(n, 0) + " + " + ".join(f"cast(NOT has_{i} AS int)" for i in range(len(EXPECTED))) + " AS n_warnings, n_mapped_columns AS n_column_map "
        "FROM header_counts LEFT JOIN per_table USING (table_id)",
        "cells_to_wide": _with(_cells(), _mapped("cells", f"{K}, raw_value"))
        + f"SELECT {K}, {wide}, count(*) FILTER (WHERE canonical IS NULL OR rn > 1) AS n_other FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {K}, coalesce(canonical, raw_header) ORDER BY position) AS rn FROM mapped) GROUP BY {K}",
        "union_tables": _with(_raw()) + f'SELECT {K}, paper_id, "BET_m2_g", NULL AS "capacity_mAh_g" FROM raw UNION ALL SELECT {K}, paper_id, NULL, "capacity_mAh_g" FROM raw',
        "fmt6g_text": "SELECT l_orderkey AS k, l_partkey AS p, l_suppkey AS s, l_linenumber AS n, printf('%.6g', l_extendedprice) AS price, "
        "printf('%.6g', l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS charge, printf('%.6g', l_discount / 1000) AS small, "
        "printf('%.6g', l_extendedprice * 1e6) AS large, printf('%.6g', -l_extendedprice / 7) AS negative FROM lineitem",
        "run_manifest": flags_and_log + "\nSELECT 'assaysift' AS tool, 'lineitem' AS input_path, (SELECT count(*) FROM norm) AS n_rows, "
        f"{len(RAW)} AS n_raw_columns, 1 AS n_unknown_columns, total AS n_flags, (SELECT count(*) FROM log) AS n_corrections, {DECISION} AS decision, "
        f"'cleaned_database,flagged_records' AS outputs FROM (SELECT {COUNTS}, count(*) AS total FROM flags)",
        "report_rows": flags_and_log + f",\n{FIELD_COUNTS},\n{TYPE_COUNTS},\n{TOP},\ncounts AS (SELECT {COUNTS} FROM flags)\n"
        f"SELECT 'decision' AS section, 0 AS ord, 'decision' AS key, {DECISION} AS value FROM counts "
        "UNION ALL SELECT 'counts', 0, 'n_rows', cast(count(*) AS varchar) FROM norm "
        f"UNION ALL SELECT 'counts', 1, 'n_raw_columns', '{len(RAW)}' UNION ALL SELECT 'counts', 2, 'n_unknown_columns', '1' "
        + " ".join(f"UNION ALL SELECT 'counts', {10 + i}, '{p}', cast(\"{p}\" AS varchar) FROM counts" for i, p in enumerate(("P0", "P1", "P2")))
        + " UNION ALL SELECT 'counts', 20, 'n_corrections', cast(count(*) AS varchar) FROM log "
        "UNION ALL SELECT 'correction_types', i, correction_type, cast(n AS varchar) FROM types "
        "UNION ALL SELECT 'risk_fields', i, field, cast(n AS varchar) FROM fields "
        "UNION ALL SELECT 'top_items', i, risk_level || ' ' || paper_id || ' ' || sample_id || ' ' || field, rule_code FROM top",
        "csv_roundtrip": _with(_raw()) + f"SELECT cast(k AS bigint) AS k, cast(p AS bigint) AS p, cast(s AS bigint) AS s, cast(n AS bigint) AS n, cast(e AS bigint) AS e, "
        + ", ".join(_null_tokens(c) for c in CANON) + " FROM raw",
        "csv_quoted_breaks": f"WITH base AS (SELECT {BASE} FROM lineitem) SELECT {K}, {NOTE} AS note, q AS quantity FROM base",
        "paper_outliers": _with(_clean(), _outliers())
        + f"SELECT {K}, paper_id, sample_id, field, 'P1' AS risk_level, 'paper_outlier' AS rule_code, v AS value_num, 4000 + field_pos AS flag_seq, "
        + f"cast(v AS varchar) AS value FROM apart JOIN spreads USING (paper_key, field) WHERE spread > 0 AND apart > spread * 1.4826::double * 3.5::double",
        "unit_fit_flags": _with(_unit_cells())
        + f"SELECT {K}, paper_id, sample_id, field, CASE WHEN dimension IS NULL THEN 'P2' ELSE 'P1' END AS risk_level, "
        + "CASE WHEN dimension IS NULL THEN 'unit_unread' ELSE 'unit_mismatch' END AS rule_code, NULL::double AS value_num, 5000 + field_pos AS flag_seq, value "
        + "FROM cells LEFT JOIN known USING (unit) WHERE unit <> '' AND (dimension IS NULL OR dimension <> expected)",
        "unit_dimensions": _with(_unit_cells())
        + "SELECT field_pos, unit, count(*) AS n, dimension, log_factor, dimension = expected AS fits FROM cells LEFT JOIN known USING (unit) "
        + "WHERE unit <> '' GROUP BY ALL",
        "csv_mixed_headers": _with(_raw()) + f"SELECT {', '.join(f'cast({k} AS bigint) AS {k}' for k in K.split(', '))}, "
        + ", ".join(_null_tokens(c) for c in ("paper_id", "BET_m2_g")) + ", CASE WHEN p % 3 = 2 THEN concat('x', p) END AS extra FROM raw",
        "txt_roundtrip": _with(_raw()) + f"SELECT {', '.join(f'cast({k} AS bigint) AS {k}' for k in K.split(', '))}, "
        + ", ".join(_null_tokens(c) for c in ("paper_id", "d002_nm")) + " FROM raw",
        "flags_sink": flags + f"SELECT {K}, paper_id, sample_id, field, CASE WHEN flag_seq >= 3000 THEN NULL ELSE coalesce(cast(value_num AS varchar), '') END AS value, risk_level FROM flags",
        "correction_sink": log + f"SELECT {K}, paper_id, sample_id, field, original_value, cleaned_value, correction_type, confidence FROM log",
        "custom_rules": _with(_clean()) + f"SELECT {K}, 'BET_m2_g' AS field, 'P0' AS risk_level, 'above_hard_max' AS rule_code, \"BET_m2_g\" AS value_num FROM norm WHERE \"BET_m2_g\" > 900 "
        f"UNION ALL SELECT {K}, 'ID_IG', 'P1', 'below_soft_min', \"ID_IG\" FROM norm WHERE \"ID_IG\" < 1.2 "
        f"UNION ALL SELECT {K}, 'sample_name', 'P2', 'missing_recommended', NULL FROM norm WHERE {MISSING.format(c='sample_name')} "
        f"UNION ALL SELECT {K}, 'mass_loading_mg_cm2', 'P2', 'missing_engineering', NULL FROM norm WHERE \"mass_loading_mg_cm2\" IS NULL",
        "dup_integer_id": "SELECT l_partkey AS p, count(*) AS n FROM (SELECT l_partkey, l_orderkey * 1000003 AS id FROM lineitem) "
        "WHERE id IN (SELECT l_orderkey * 1000003 FROM lineitem GROUP BY 1 HAVING count(*) > 1) GROUP BY 1",
        "csv_row_index": "SELECT count(*) AS n, 0::bigint AS lowest, count(*) - 1 AS highest, count(*) AS distinct_rows FROM lineitem",
        "parquet_row_index": "SELECT count(*) AS n, 0::bigint AS lowest, count(*) - 1 AS highest, count(*) AS distinct_rows FROM lineitem",
    }
