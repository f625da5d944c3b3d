"""Train types from ids, agencies and names (CLS-01 to CLS-06): ordered rule sets that become one CASE expression.

A rule is (label, substrings): the first rule with a substring in the upper-cased text gives the label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

Rules = Sequence[tuple[str, Sequence[str]]]

#: Fixed values, in order. "INTERCITES" holds "TER", so its rule is only reached in the second set.
STOP_ID_RULES: Rules = [
    ("TGV InOui", ["TGV INOUI", "INOUI", "TGV"]),
    ("OUIGO", ["OUIGO"]),
    ("TER", ["TER"]),
    ("Intercités", ["INTERCITES", "INTERCITÉS"]),
    ("ICE", ["ICE"]),
    ("Transilien", ["TRANSILIEN", "RER"]),
    ("Eurostar", ["EUROSTAR", "THALYS"]),
]
AGENCY_RULES: Rules = [("Thalys", ["EUROSTAR_CONTINENTAL"]), ("Eurostar", ["EUROSTAR_CHANNEL"])]
STOP_NAME_RULES: Rules = [
    ("Car TER", ["CAR TER"]),
    ("Car à réservation", ["CAR À RÉSERVATION", "CAR A RESERVATION"]),
    ("Eurostar", ["EUROSTAR"]),
    ("ICE", ["ICE"]),
    ("INTERCITES", ["INTERCITÉS", "INTERCITES"]),
    ("Lyria", ["LYRIA"]),
    ("OUIGO", ["OUIGO"]),
    ("TGV INOUI", ["TGV INOUI", "INOUI", "TGV"]),
    ("TramTrain", ["TRAMTRAIN", "TRAM TRAIN"]),
    ("Train TER", ["TER", "TRAIN TER"]),
]
ROUTE_NAME_RULES: Rules = [
    ("AVE", ["AVE"]),
    ("Avlo", ["AVLO"]),
    ("Alvia", ["ALVIA"]),
    ("Euromed", ["EUROMED"]),
    ("Intercity", ["INTERCITY"]),
    ("Media Distancia", ["MD", "MEDIA"]),
    ("Cercanías", ["CERCANIAS", "RODALIES"]),
    ("Regional", ["REGIONAL"]),
    ("Tren Celta", ["TRENCELTA"]),
]
SINGLE_FEED_RULES: Rules = [("EUROSTAR CHANNEL", ["CHANNEL"]), ("EUROSTAR CONTINENTAL", ["CONTINENTAL"])]
MERGED_AGENCY_RULES: Rules = [("Eurostar (ex-Thalys)", ["THALYS"])]


def compiled(rules: Rules, text: Column, otherwise: Column | str | None) -> Column:
    upper, out = F.upper(text), None
    for label, parts in rules:
        hit = None
        for p in parts:
            hit = F.contains(upper, F.lit(p)) if hit is None else hit | F.contains(upper, F.lit(p))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(F.lit(otherwise) if not isinstance(otherwise, Column) else otherwise)


def labels_of(rules: Rules) -> list[str]:
    return [label for label, _ in rules]


def index_of(rules: Rules, text: Column) -> Column:
    """The number of the first rule that holds, else null: a number costs an ordered aggregation less than a label."""
    return compiled([(i, parts) for i, (_, parts) in enumerate(rules)], text, F.lit(None).cast("int"))


def type_of_stop_id(stop_id: Column) -> Column:
    """CLS-01: '' where no rule holds."""
    return compiled(STOP_ID_RULES, stop_id, "")


def type_of_route_names(short: Column, long: Column, route_id: Column, strict: bool = True) -> Column:
    """CLS-02: by short name, long name and id together, else the long name, else 'Train Renfe'.

    strict: a null is read as the word 'nan', as text formatting of a missing value gives; otherwise as ''.
    """
    none = F.lit("nan" if strict else "")
    parts = [F.coalesce(c, none) for c in (short, long, route_id)]
    name = F.trim(parts[1])
    return compiled(ROUTE_NAME_RULES, F.concat_ws(" ", *parts), F.when(name != "", name).otherwise("Train Renfe"))


def type_of_agency_or_stop(agency: Column, stop: Column, defaults: Column) -> Column:
    """CLS-03 and CLS-06: by agency, else by stop id, else the operator's first transport type, else 'Train'."""
    fallback = F.coalesce(F.get(defaults, F.lit(0)), F.lit("Train"))
    return compiled(AGENCY_RULES, agency, compiled(STOP_NAME_RULES, stop, fallback))


def type_of_single_feed_agency(agency: Column) -> Column:
    """CLS-04."""
    return compiled(SINGLE_FEED_RULES, agency, "EUROSTAR")


def type_of_merged_agency(agency: Column) -> Column:
    """CLS-05."""
    return compiled(MERGED_AGENCY_RULES, agency, "Eurostar")
