"""SQL for the Merkle manifest query, one set of tables per level."""

from __future__ import annotations

from ledgerlark.llm.merkle_manifest import FAN, FIELDS

# Enough for FAN ** LEAF_LEVELS rows a group and FAN ** GROUP_LEVELS groups.
LEAF_LEVELS = 7
GROUP_LEVELS = 4
_CRC_STEP = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT))"
    byte = f"list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: {_CRC_STEP})"
    whole = f"list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda a, b: {byte})"
    return f"xor({whole}, 4294967295)"


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(text if f == 'text' else f) for f in FIELDS)})"


def _levels(name: str, levels: int) -> list[str]:
    """Tables ``<name>1 ..`` of nodes and ``<name>s0 ..`` of siblings above ``<name>0`` (g, idx, n, node)."""
    out = []
    for i in range(levels):
        run = f"PARTITION BY g, idx // {FAN} ORDER BY idx ROWS BETWEEN"
        out.append(
            f"{name}s{i} AS (SELECT g, idx, n, "
            f"coalesce(string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b, "
            f"coalesce(string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a "
            f"FROM {name}{i})"
        )
        out.append(
            f"{name}{i + 1} AS (SELECT g, idx // {FAN} AS idx, (n + {FAN - 1}) // {FAN} AS n, "
            "CASE WHEN n > 1 THEN sha256(string_agg(node, '' ORDER BY idx)) ELSE min(node) END AS node "
            f"FROM {name}{i} GROUP BY g, idx // {FAN}, n)"
        )
    return out


def _fold(name: str, source: str, first: str, levels: int) -> list[str]:
    """``<name>f0 ..``: the folded digest and the proof so far, a level at a time."""
    out = [f"{first} AS ({source})"]
    for i in range(levels):
        old = first if i == 0 else f"{name}f{i}"
        out.append(
            f"{name}f{i + 1} AS (SELECT f.* REPLACE ("
            "CASE WHEN s.n > 1 THEN sha256(s.b || f.up || s.a) ELSE f.up END AS up, "
            "CASE WHEN s.n > 1 THEN f.proof || s.b || s.a ELSE f.proof END AS proof, "
            f"f.idx // {FAN} AS idx) FROM {old} f JOIN {name}s{i} s ON f.g = s.g AND f.idx = s.idx)"
        )
    return out


def merkle_sql() -> str:
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    tables = [
        f"leaf AS (SELECT doc_id, coalesce('1' || lang, '0') AS g, {_leaf('text')} AS leaf, "
        f"CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {_leaf(lowered)} "
        f"ELSE {_leaf('text')} END AS start FROM documents)",
        "d0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, "
        "count(*) OVER (PARTITION BY g) AS n, leaf AS node FROM leaf)",
        *_levels("d", LEAF_LEVELS),
        f"r0 AS (SELECT 0 AS g, g AS lang_key, row_number() OVER (ORDER BY g) - 1 AS idx, "
        f"count(*) OVER () AS n, node FROM d{LEAF_LEVELS})",
        *_levels("r", GROUP_LEVELS),
        *_fold("d", "SELECT g, idx, doc_id, leaf, start AS up, '' AS proof FROM d0", "df0", LEAF_LEVELS),
        *_fold(
            "r",
            "SELECT 0 AS g, r.idx, d.doc_id, d.leaf, d.up, d.proof, r.node AS subroot "
            f"FROM df{LEAF_LEVELS} d JOIN r0 r ON d.g = r.lang_key",
            "rf0",
            GROUP_LEVELS,
        ),
    ]
    return (
        "WITH " + ",\n".join(tables) + "\nSELECT f.doc_id, f.leaf, f.subroot, t.node AS root, "
        "sha256(f.proof) AS proof_sha256, f.up AS folded_root, f.up = t.node AS verified "
        f"FROM rf{GROUP_LEVELS} f JOIN r{GROUP_LEVELS} t ON f.g = t.g"
    )
