"""DuckDB oracle SQL, built from shared CTE pieces.

Every string here is an independent, brute-force formulation of what the
Spark plans compute (all pairs where the Spark plan uses an inverted index,
a direct window where Spark uses a histogram). Tables are the driver views:
``documents``, ``labels``, ``benchmark``, ``embeddings``.
"""

from __future__ import annotations

from reuselens.operators import minhash as MH
from reuselens.operators import tuning as TU

CLEAN = r"trim(regexp_replace(lower(coalesce({c}, '')), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"
HASH32 = "('0x' || substr(md5({s}), 1, 8))::BIGINT"


def clean(c: str) -> str:
    return CLEAN.format(c=c)


def hash32(s: str) -> str:
    return HASH32.format(s=s)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CTE_LABELS = """lab AS (
  SELECT d.doc_id, d.lang AS task,
    CASE WHEN d.doc_id % 20 = 0 THEN 'orig'
         WHEN l.quality = 1 AND l.toxic = 0 THEN 'non'
         WHEN l.quality = 1 AND l.toxic = 1 THEN 'heavy'
         WHEN l.quality = 0 AND l.toxic = 1 THEN 'light'
         WHEN l.quality = 0 AND l.toxic = 0 THEN 'cut' END AS category
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
labs AS (
  SELECT *,
    CAST(CASE category WHEN 'non' THEN 0 WHEN 'heavy' THEN 1 WHEN 'light' THEN 2
                       WHEN 'cut' THEN 3 WHEN 'orig' THEN -1 END AS INTEGER) AS category_id,
    CAST(CASE WHEN category = 'non' THEN 0 WHEN category = 'orig' THEN -1 ELSE 1 END AS INTEGER) AS plag_label,
    CASE category WHEN 'cut' THEN 'cut / near copy' WHEN 'light' THEN 'light plagiarism'
                  WHEN 'heavy' THEN 'heavy plagiarism' WHEN 'non' THEN 'non-plagiarised'
                  WHEN 'orig' THEN 'non-plagiarised' END AS truth_level
  FROM lab)"""

CTE_TEXTS = f"""txt AS (
  SELECT doc_id, coalesce(text, '') AS raw_text, {clean('text')} AS clean_text FROM documents)"""

CTE_TOKENS = """tok AS (
  SELECT doc_id, CASE WHEN clean_text = '' THEN []::VARCHAR[]
                      ELSE string_split(clean_text, ' ') END AS w FROM txt)"""

CTE_SHINGLES = """sh AS (
  SELECT doc_id, unnest(list_distinct(list_transform(range(0, len(w) - 2),
         lambda j: array_to_string(w[j + 1:j + 3], ' ')))) AS s FROM tok)"""


def cte_params() -> str:
    rows = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(MH.hash_params()))
    return f"params(i, a, b) AS (VALUES {rows})"


def cte_signature(src_txt: str = "txt", key: str = "doc_id", name: str = "sig") -> str:
    """Long signature (key, i, m) of every row of ``src_txt`` via a plain
    cross product of shingles and hash functions."""
    return f"""{name}_tok AS (
  SELECT {key}, CASE WHEN clean_text = '' THEN []::VARCHAR[]
                     ELSE string_split(clean_text, ' ') END AS w FROM {src_txt}),
{name}_sh AS (
  SELECT {key}, unnest(list_distinct(list_transform(range(0, len(w) - 2),
         lambda j: array_to_string(w[j + 1:j + 3], ' ')))) AS s FROM {name}_tok),
{name}_hx AS (SELECT {key}, {hash32('s')} AS x FROM {name}_sh),
{name} AS (
  SELECT t.{key}, p.i, coalesce(min((p.a * h.x + p.b) % {MH.P}), {MH.P}) AS m
  FROM {src_txt} t CROSS JOIN params p LEFT JOIN {name}_hx h ON h.{key} = t.{key}
  GROUP BY t.{key}, p.i)"""


def cte_minhash_best(doc_sig: str = "sig", orig_sig: str = "sig",
                     orig_key: str = "doc_id", orig_filter: str = "o.doc_id % 20 = 0",
                     name: str = "mhb") -> str:
    """Brute force: every document against every original."""
    return f"""{name}_pairs AS (
  SELECT d.doc_id, o.{orig_key} AS orig_id, sum(CASE WHEN d.m = o.m THEN 1 ELSE 0 END) AS n_eq
  FROM {doc_sig} d JOIN {orig_sig} o ON d.i = o.i
  WHERE {orig_filter}
  GROUP BY d.doc_id, o.{orig_key}),
{name} AS (
  SELECT doc_id, orig_id AS best_original, CAST(n_eq AS DOUBLE) / {float(MH.NUM_HASHES)}::DOUBLE AS best_sim FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n_eq DESC, orig_id) AS rn
    FROM {name}_pairs) WHERE rn = 1)"""


def level_case(sim: str, t_cut="0.85::DOUBLE", t_light="0.6::DOUBLE",
               t_heavy="0.35::DOUBLE") -> str:
    return (f"CASE WHEN {sim} > {t_cut} THEN 'cut / near copy' "
            f"WHEN {sim} > {t_light} THEN 'light plagiarism' "
            f"WHEN {sim} > {t_heavy} THEN 'heavy plagiarism' ELSE 'non-plagiarised' END")


def cte_grid() -> str:
    rows = ", ".join(f"({a!r}, {b!r}, {c!r})" for a, b, c in TU.threshold_grid())
    return f"grid(t_cut, t_light, t_heavy) AS (VALUES {rows})"
