"""Writing catalogs, documents, indexes and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Head of the published index.
INDEX_TITLE = "# 📇 Índice de Leyes Federales Vigentes"
INDEX_SOURCE = "> Generado automáticamente desde el catálogo de [diputados.gob.mx](https://www.diputados.gob.mx/LeyesBiblio/index.htm).  "
INDEX_COLUMNS = ["| No. | Ley | Última Reforma | Markdown |", "|----:|-----|---------------|:--------:|"]


def write_catalog(catalog: DataFrame, path: str, single_array: bool = False) -> None:
    """JSON lines, or one array in one text file (for a catalog, which is small by nature)."""
    entries = catalog.drop("pos")
    if not single_array:
        entries.write.mode("overwrite").json(path)
        return
    one = F.struct("pos", F.to_json(F.struct(*entries.columns)).alias("j"))
    rows = F.transform(F.array_sort(F.collect_list(one)), lambda e: e["j"])
    catalog.agg(F.concat(F.lit("["), F.array_join(rows, ",\n"), F.lit("]")).alias("value")).write.mode("overwrite").text(path)


def write_documents(rendered: DataFrame, path: str) -> None:
    """One folder per document (md_slug) with its text (and a final newline); an executor writes its own documents."""
    rendered.select("md_slug", F.col("content").alias("value")).repartition("md_slug").write.mode("overwrite").partitionBy("md_slug").text(path)


def index_lines(index: DataFrame, today: str, done: int, total: int) -> DataFrame:
    """(n, value): lines of the coverage index, each entry once; ``today`` is given, so results repeat."""
    pct = done * 100 // total if total else 0
    state = f"> Última actualización: **{today}** — **{done}/{total}** leyes disponibles en Markdown ({pct}%)."
    head = [INDEX_TITLE, "", INDEX_SOURCE, state, "", "---", "", *INDEX_COLUMNS]
    first = index.sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, head))).alias("n", "value"))
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(c, F.lit("")) for c in ("numero", "nombre", "ultima_reforma", "md_link"))), F.lit(" |"))
    return first.unionByName(index.select((F.col("pos") + len(head)).cast("int").alias("n"), cells.alias("value")))


def write_index(lines: DataFrame, path: str) -> None:
    """One text file in order; an index has one short line per law."""
    lines.orderBy("n").select("value").coalesce(1).write.mode("overwrite").text(path)
