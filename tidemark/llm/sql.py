"""SQL equivalents of those training-data queries that SQL can express on whole tables."""

from tidemark.plans.records import page_sql

SQL: dict[str, str] = {
    "p3_exact": f"""WITH c AS (SELECT cand_no, id_na_fonte, nullif(hash_texto, '') AS h, {page_sql("nullif(url, '')")} AS page FROM lotes WHERE cand_no IS NOT NULL),
seen AS (SELECT unnest(map_keys(vistos)) AS k, unnest(map_values(vistos)) AS v FROM openalex_carandiru),
first AS (SELECT *, min(cand_no) OVER (PARTITION BY page) AS fp, min(cand_no) OVER (PARTITION BY h) AS fh FROM c)
SELECT cand_no FROM first WHERE (page IS NOT NULL AND (fp < cand_no OR page IN (SELECT id FROM catalogo WHERE id <> '')))
  OR (h IS NOT NULL AND (fh < cand_no OR h IN (SELECT hash_texto FROM catalogo WHERE hash_texto <> '') OR h IN (SELECT v FROM seen WHERE v <> '')))
  OR id_na_fonte IN (SELECT k FROM seen)""",
    "p4_copies": "SELECT ord, min(ord) OVER (PARTITION BY texto) AS primeiro, count(*) OVER (PARTITION BY texto) AS n FROM documento WHERE texto IS NOT NULL",
}
