"""Clinical rules as plain data.

The operators read their vocabularies, unit factors, cut-offs and score bands
from here and turn them into Spark column expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

DEFAULT_WEIGHT_KG = 80


@dataclass(frozen=True)
class Unit:
    """Dose unit: rate * numerator / denominator, per kg of weight if asked for."""

    numerator: int = 1
    denominator: int = 1
    by_weight: bool = False


@dataclass(frozen=True)
class Concentration:
    """What one order says about the infused fluid.

    ``mg`` in ``ml`` gives a dose from the pump speed, ``fixed`` is a dose by
    itself, and neither of them means that the dose is unknown.
    """

    mg: int | None = None
    ml: int | None = None
    fixed: float | None = None


@dataclass(frozen=True)
class OrderRule:
    """Orders with one of these names (or like the pattern), and that dosage."""

    concentration: Concentration
    names: tuple[str, ...] = ()
    like: str | None = None
    dosage: str | None = None


@dataclass(frozen=True)
class DrugRule:
    name: str
    select_like: tuple[str, ...]
    drop_rates: tuple[str, ...] = ("",)
    drop_rates_like: tuple[str, ...] = ()
    # labels: a stay with the blank label gets its labels filled in time order
    blank_label: str | None = None
    fill_like: tuple[str, ...] = ()
    keep_like: tuple[str, ...] = ()
    known_labels: tuple[str, ...] = ()
    known_like: tuple[tuple[str, str], ...] = ()
    # dose conversion
    units: tuple[tuple[str, tuple[str, ...]], ...] = ()
    volume_labels: tuple[str, ...] = ()
    volume_default: Concentration | None = None
    order_like: str | None = None
    orders: tuple[OrderRule, ...] = ()

    @property
    def imputed(self) -> bool:
        return self.blank_label is not None

    def possible_orders(self) -> tuple[OrderRule, ...]:
        """The order rules without names that ``order_like`` never lets through."""
        wanted = re.compile(".*".join(map(re.escape, (self.order_like or "%").split("%"))), re.S)
        rules = [replace(o, names=tuple(n for n in o.names if wanted.fullmatch(n))) for o in self.orders]
        return tuple(o for o in rules if o.names or o.like)

    def concentrations(self) -> list[Concentration]:
        """The distinct outcomes an order can have, in rule order."""
        outcomes = [o.concentration for o in self.possible_orders()]
        return list(dict.fromkeys([*outcomes, self.volume_default]))


# --- fixed values: dose units -> mcg/kg/min --------------------------------
UNITS = {
    "mcg/kg/min": Unit(),
    "mcg/kg/hr": Unit(1, 60),
    "mcg/hr": Unit(1, 60, True),
    "mcg/min": Unit(1, 1, True),
    "mg/hr": Unit(1000, 60, True),
    "mg/min": Unit(1000, 1, True),
    "mg/kg/min": Unit(1000, 1),
    "nanograms/kg/min": Unit(1, 1000),
}

# --- fixed values: drug vocabularies ---------------------------------------
DOBUTAMINE = DrugRule(
    name="dobutamine",
    select_like=("%Dobutamine%", "%DOBUTamine%"),
)

DOPAMINE = DrugRule(
    name="dopamine",
    select_like=("%dopamine%", "%Dopamine%", "%DOPamine%"),
    drop_rates=("OFF", "ERROR", "UD", ""),
    drop_rates_like=("%Time Correction%",),
    blank_label="Dopamine ()",
    fill_like=("%Dopamine%",),
    keep_like=("%dopamine%",),
    known_labels=("Dopamine (mcg/kg/hr)", "Dopamine (mcg/kg/min)", "Dopamine (ml/hr)", "Dopamine"),
    units=(
        (
            "mcg/kg/min",
            (
                "Dopamine (mcg/kg/min)",
                "dopamine (mcg/kg/min)",
                "DOPamine STD 15 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)",
                "DOPamine STD 400 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)",
                "DOPamine STD 400 mg Dextrose 5% 500 ml  Premix (mcg/kg/min)",
                "DOPamine MAX 800 mg Dextrose 5% 250 ml  Premix (mcg/kg/min)",
            ),
        ),
        ("mcg/kg/hr", ("Dopamine (mcg/kg/hr)",)),
        ("mcg/hr", ("Dopamine (mcg/hr)",)),
        ("mcg/min", ("Dopamine (mcg/min)",)),
        ("mg/hr", ("Dopamine (mg/hr)",)),
        ("nanograms/kg/min", ("Dopamine (nanograms/kg/min)",)),
    ),
    volume_labels=("Dopamine (ml/hr)",),
    volume_default=Concentration(4, 250),
)

EPINEPHRINE = DrugRule(
    name="epinephrine",
    select_like=("Epinephrine%", "EPINEPHrine%"),
    drop_rates=("",),
    drop_rates_like=("%OFF%", "%50%mcg%", "%br%"),
    blank_label="Epinephrine ()",
    fill_like=("Epinephrine%",),
    keep_like=("Epinephrine%",),
    known_labels=("Epinephrine",),
    units=(
        (
            "mcg/min",
            (
                "Epinephrine (mcg/min)",
                "EPINEPHrine(Adrenalin)STD 4 mg Sodium Chloride 0.9% 500 ml (mcg/min)",
                "EPINEPHrine(Adrenalin)STD 7 mg Sodium Chloride 0.9% 250 ml (mcg/min)",
                "EPINEPHrine(Adrenalin)MAX 30 mg Sodium Chloride 0.9% 250 ml (mcg/min)",
            ),
        ),
        ("mcg/kg/min", ("Epinephrine (mcg/kg/min)",)),
        ("mcg/hr", ("Epinephrine (mcg/hr)",)),
        ("mg/kg/min", ("Epinephrine (mg/kg/min)",)),
        ("mg/hr", ("Epinephrine (mg/hr)",)),
    ),
    volume_labels=("Epinephrine (ml/hr)",),
    volume_default=Concentration(4, 250),
    order_like="Epinephrine%",
    orders=(OrderRule(Concentration(8, 250), names=("EPINEPHrine 8 MG in 250 mL NS",)),),
)

NOREPINEPHRINE = DrugRule(
    name="norepinephrine",
    select_like=("%Norepinephrine%", "%norepinephrine%"),
    drop_rates=("Documentation undone", "ERROR", "UD", ""),
    drop_rates_like=("%OFF%",),
    blank_label="Norepinephrine ()",
    fill_like=("%Norepinephrine%", "%norepinephrine%"),
    keep_like=("%Norepinephrine%",),
    known_labels=(
        "Norepinephrine (mcg/kg/hr)",
        "Norepinephrine (mcg/kg/min)",
        "Norepinephrine (mcg/min)",
        "Norepinephrine (mg/hr)",
        "Norepinephrine (mg/min)",
        "Norepinephrine (ml/hr)",
        "Norepinephrine",
    ),
    known_like=(("%norepinephrine%", "Norepinephrine (ml/hr)"),),
    units=(
        (
            "mcg/min",
            (
                "Norepinephrine (mcg/min)",
                "Norepinephrine STD 4 mg Dextrose 5% 250 ml (mcg/min)",
                "Norepinephrine STD 4 mg Dextrose 5% 500 ml (mcg/min)",
                "Norepinephrine STD 8 mg Dextrose 5% 250 ml (mcg/min)",
                "Norepinephrine STD 8 mg Dextrose 5% 500 ml (mcg/min)",
                "Norepinephrine STD 32 mg Dextrose 5% 282 ml (mcg/min)",
                "Norepinephrine STD 32 mg Dextrose 5% 500 ml (mcg/min)",
                "Norepinephrine MAX 32 mg Dextrose 5% 250 ml (mcg/min)",
                "Norepinephrine MAX 32 mg Dextrose 5% 500 ml (mcg/min)",
            ),
        ),
        ("mcg/kg/min", ("Norepinephrine (mcg/kg/min)",)),
        ("mcg/hr", ("Norepinephrine (mcg/hr)",)),
        ("mg/hr", ("Norepinephrine (mg/hr)",)),
        ("mcg/kg/hr", ("Norepinephrine (mcg/kg/hr)",)),
        ("mg/min", ("Norepinephrine (mg/min)",)),
        ("mg/kg/min", ("Norepinephrine (mg/kg/min)",)),
    ),
    volume_labels=("Norepinephrine (ml/hr)", "norepinephrine Volume (ml) (ml/hr)"),
    volume_default=Concentration(),
    order_like="%Norepinephrine%",
    orders=(
        OrderRule(
            Concentration(4, 250),
            names=("PRMX NOREPInephrine 4 mg/250 mL NS Drip", "NOREPINEPHRINE 4 MG/250 ML NS"),
            like="NOREPINEPHRINE%4%MG%250%C%REPACKAGE%",
        ),
        OrderRule(
            Concentration(8, 250),
            names=(
                "250 ML PLAS CONT : NOREPINEPHRINE IN D5W 8 MG/250 ML",
                "NOREPINEPHRINE 8 MG in 250mL NS",
            ),
        ),
        OrderRule(
            Concentration(1, 1),
            names=(
                "NOREPINEPHRINE BITARTRATE 1 MG/ML AMP",
                "NOREPINEPHRINE BITARTRATE 1 MG/ML IJ SOLN",
                "NOREPINEPHRINE BITARTRATE 1 MG/ML IV : 4 ML",
                "NOREPINEPHRINE BITARTRATE 1 MG/ML IV SOLN",
            ),
        ),
        OrderRule(Concentration(fixed=0.2), names=("<<norepinephrine 4 mg/4 mL Inj",)),
        OrderRule(Concentration(16, 250), names=("NOREPINEPHRINE",), dosage="16 MG"),
        OrderRule(Concentration(4, 250), names=("NOREPINEPHRINE",), dosage="4 MG"),
        OrderRule(Concentration(8, 250), names=("NOREPINEPHRINE",), dosage="8 MG"),
    ),
)

DRUGS = (DOBUTAMINE, DOPAMINE, EPINEPHRINE, NOREPINEPHRINE)

# --- fixed values: ventilation vocabulary ----------------------------------
VENT_GROUPS = ("Airway", "Ventilation")
VENT_ON_LIKE = ("Intubated%",)
VENT_ON = (
    "Ventilated - chronic dependency",
    "Ventilated - with daily extubation evaluation",
    "Ventilated - with no daily extubation trial",
    "Non-invasive ventilation",
)
VENT_CLOSING_VALUE = "Spontaneous - adequate"
VENT_CLOSING_GROUP = "Airway"
VENT_OPEN_TAIL_MINUTES = 60

# --- fixed values: weights --------------------------------------------------
WEIGHT_SWAP_STAYS = (1355321, 2387379)
WEIGHT_MIN_KG = 2.5
WEIGHT_RATIO_LOW = 0.15
WEIGHT_RATIO_HIGH = 6.9

# --- fixed values: pressure limits (open ranges above zero) -----------------
PRESSURE_LIMITS = {"sbp": 400, "dbp": 300, "map": 300}

# --- fixed values: cohort and grid ------------------------------------------
AGE_CAP_LABEL = "> 89"
AGE_CAP_VALUE = "91.4"
GRID_LEAD_HOURS = 24
ROLLING_HOURS = 24

# --- fixed values: score bands, worst first ---------------------------------
PLATELETS_BELOW = ((20, 4), (50, 3), (100, 2), (150, 1))
BILIRUBIN_FROM = ((12.0, 4), (6.0, 3), (2.0, 2), (1.2, 1))
PF_VENT_BELOW = ((100, 4), (200, 3))
PF_NOVENT_BELOW = ((300, 2), (400, 1))
GCS_BELOW = ((6, 4),)
GCS_BETWEEN = ((6, 9, 3), (10, 12, 2), (13, 14, 1))
CREATININE_FROM = ((5.0, 4), (3.5, 3), (2.0, 2), (1.2, 1))
URINE_BELOW = ((200, 4), (500, 3))
DOPAMINE_ABOVE = ((15, 4), (5, 3), (0, 2))
CATECHOLAMINE_LIMIT = 0.1
MAP_BELOW = ((70, 1),)

ORGANS = ("respiration", "coagulation", "liver", "cardiovascular", "cns", "renal")
ORGAN_LEVELS = (1, 2, 3, 4)
