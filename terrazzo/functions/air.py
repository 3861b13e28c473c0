"""Air quality documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: air quality labels, best first
AIR_LABELS = ("Bon", "Moyen", "Dégradé", "Mauvais", "Très mauvais", "Extrêmement mauvais")


def severity(label: Column) -> Column:
    """Rank 1..6 of a label, null if it is not one."""
    rank = F.array_position(F.array(*[F.lit(x) for x in AIR_LABELS]), label)
    return F.when(rank > 0, rank).cast("int")


def worst_pollutants(reading: dict[str, Column]) -> Column:
    """Names of the pollutants that share the worst label, in the given order."""
    ranks = {name: severity(label) for name, label in reading.items()}
    worst = F.greatest(*ranks.values())
    hits = F.array(*[F.when(rank == worst, F.lit(name)) for name, rank in ranks.items()])
    return F.when(worst.isNotNull(), F.array_join(hits, ","))


def document_label(document: Column, code: Column | None = None) -> Column:
    """The label of an air document held as JSON text, see `variant_label`; null if it is not JSON."""
    return variant_label(F.try_parse_json(document), code)


def variant_label(doc: Column, code: Column | None = None) -> Column:
    """The label of an air document held as a variant.

    Its `data` may be a list of readings or a map from code to such a list, of which that of the document's own `code` is
    taken, or the first one where it is not given or not there; the first reading
    gives `label`, `qualif` or `indice`. Otherwise top-level `label`, `today`, `indice`,
    `qualif` are tried, each either text or an object with `label` or `qualif`.
    """
    def text(path: str) -> Column:
        return F.nullif(F.try_variant_get(doc, path, "string"), F.lit(""))

    def kind(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(doc, path, "variant"))

    listed = F.try_variant_get(doc, "$.data[0]", "map<string,string>")
    by_code = F.try_variant_get(doc, "$.data", "map<string,array<map<string,string>>>")
    readings = F.get(F.map_values(by_code), F.lit(0))
    if code is not None:
        readings = F.coalesce(F.try_element_at(by_code, code), readings)
    mapped = F.get(readings, F.lit(0))
    candidates = [
        F.nullif(F.try_element_at(reading, F.lit(key)), F.lit(""))
        for reading in (listed, mapped)
        for key in ("label", "qualif", "indice")
    ]
    for key in ("label", "today", "indice", "qualif"):
        candidates.append(
            F.when(kind(f"$.{key}") == "STRING", text(f"$.{key}")).when(
                kind(f"$.{key}").startswith("OBJECT"),
                F.coalesce(text(f"$.{key}.label"), text(f"$.{key}.qualif")),
            )
        )
    return F.coalesce(*candidates)
