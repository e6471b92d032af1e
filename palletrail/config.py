"""Fixed values and rule tables used by the reports.

Everything here is data: codes as the warehouse system writes them, labels as the
reports print them, and parameters a site may replace.  Rules are applied by
``palletrail.functions.rules``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: process codes and event types of the movement ledger ---------
NORMAL = 520
DUMMY_OUT = 614
DUMMY_IN = 207
CLARIFICATION = 402
BOOKING = 202

EVENT_STARTED = 42
EVENT_DONE = 47
EVENT_BLOCKED = 39
EVENT_STATION = 101
EVENT_CLARIFIED = 102
EVENT_BOOKED = 103
EVENT_GRADED = 120

# --- Fixed values: storage areas and target places -------------------------------
RECEIVE_AREAS = ("Overstock", "SZROV")
RECEIVE_TARGET = "OV%"
SORTING_TARGETS = ("IN_SZR_OV", "SZR_OV")
SORTING_DUMMY_TARGETS = ("IN_SZR_OV",)

# --- Fixed values: keys of the attribute document, by the name used here ----------
ATTRIBUTE_KEYS = {
    "reference": "REFERENCENUMBER_LHM",
    "grade_sector": "QUALITYID_SEKTOR",
    "grade_article": "QUALITYID_ART",
    "sortable": "SORTABLE_ART",
    "category_id": "CATEGORYID_ART",
    "source_id": "SOURCEID_SEKTOR",
    "channel_id": "DISTRIBUTIONCHANNELID_ART",
    "sku": "SKU_ART",
    "sort_id": "SORTINGCRITERIAID_ART",
    "last_ean": "LASTEANGOTFROMMAUS_ZIEL",
}

# --- Fixed values: code -> label tables -------------------------------------------
GRADES = {"1": "A", "2": "B", "3": "C", "4": "D"}
CATEGORIES = {"1": "Schuhe", "2": "Textil", "3": "ACC", "4": "Home", "5": "Beauty"}
UNKNOWN = "Unknown"

# Source labels are site wording; replace them per site.
SOURCES = {"1": "Main", "10": "OSR", "11": "OSR (OV)"}
SORTING_SOURCE_DEFAULT = "Resale"


@dataclass(frozen=True)
class Shift:
    """One shift by local time of day, both ends included."""

    number: int
    start: str
    end: str


# --- Fixed values: shift table; times outside every shift have no shift ------------
SHIFTS = (Shift(1, "05:50:00", "14:44:59"), Shift(2, "14:45:00", "23:59:00"))
ORDER_SHIFT_ONE = Shift(1, "06:00:00", "14:45:00")
SITE_ZONE = "Europe/Berlin"


@dataclass(frozen=True)
class ChannelRule:
    """First matching rule names the distribution channel.

    ``test`` is one of ``target`` (LIKE pattern on the target carrier), ``channel``
    or ``source`` (code of leg 2, else leg 1), ``grade`` (sector grade of leg 1).
    """

    test: str
    values: tuple[str, ...]
    label: str


_OVERSTOCK_CARRIER = ChannelRule("target", ("50%",), "Overstock")
_DISPOSAL = ChannelRule("target", ("SPENDENLHM",), "disposal")
_CLARIFY = ChannelRule("target", ("KF_OV%",), "Clarification")
_OUTLET = ChannelRule("channel", ("4",), "Outlet")
_OVERSTOCK = ChannelRule("channel", ("3",), "Overstock")
_RETURNED_OVERSTOCK = ChannelRule("source", ("11",), "Overstock")
_BLOCKED = ChannelRule("channel", ("8",), "Blocklist")
_LOW_GRADE = ChannelRule("grade", ("3", "4"), "Overstock")

# --- Fixed values: the ordered rule lists, one per report family -------------------
CHANNEL_RULES = {
    "base": (_OVERSTOCK_CARRIER, _OUTLET, _OVERSTOCK, _RETURNED_OVERSTOCK),
    "detail": (_OVERSTOCK_CARRIER, _DISPOSAL, _OUTLET, _OVERSTOCK, _RETURNED_OVERSTOCK, _BLOCKED),
    "kpi": (_OVERSTOCK_CARRIER, _DISPOSAL, _CLARIFY, _OUTLET, _OVERSTOCK, _RETURNED_OVERSTOCK, _BLOCKED),
    "sorting": (_OVERSTOCK_CARRIER, _LOW_GRADE, _OUTLET, _OVERSTOCK),
}

# Target patterns whose answer a paired row keeps, so that the carrier itself need not
# travel with it: the ones in the rules above plus the carrier families of the volumes.
TARGET_PATTERNS = {
    "50%": "to_50",
    "SPENDENLHM": "to_disposal",
    "KF_OV%": "to_clarify",
    "3%": "to_3",
    "5%": "to_5",
    "6%": "to_6",
}


@dataclass(frozen=True)
class TransportKpi:
    """Starts still open, described by equal values and LIKE patterns on the start row.

    ``closing`` tells what ends a start within the same carrier and lifecycle:
    ``done_or_blocked`` (either, at any time), ``done_later_or_blocked`` (done after
    the start, or blocked at any time), ``done`` (done at any time).
    """

    name: str
    days: int
    like: dict[str, str] = field(default_factory=dict)
    equal: dict[str, str] = field(default_factory=dict)
    closing: str = "done_or_blocked"
    key: str = "transportlhmnr"
    exclude_area: str | None = None
    distinct: str | None = None


# --- Fixed values: the six transport KPIs of the board -----------------------------
_FROM_BGL_TO_FIN = {"transporttaskquelle": "BGL%", "transporttaskziel": "%FIN_AP%"}
_RELEASED = {"zuggruppe_sender": "BESTANDFREIGABE"}
TRANSPORT_KPIS = (
    TransportKpi(
        "bgl_bsf_ov", 7, {"transporttaskquelle": "%BGL%", "transportrequestziel": "%BSF_O%"},
        closing="done_later_or_blocked"),
    TransportKpi(
        "fin_ap_bgl", 5, {"transportrequestziel": "%BGL%"}, {"transporttaskquelle": "FIN_AP01"}),
    TransportKpi(
        "open_orders", 5, _FROM_BGL_TO_FIN, _RELEASED, closing="done", key="lhmnr",
        exclude_area="AKL", distinct="zuggruppe_token"),
    TransportKpi(
        "open_positions", 5, _FROM_BGL_TO_FIN, _RELEASED, closing="done", key="lhmnr",
        exclude_area="AKL"),
    TransportKpi(
        "we_bgl", 7, {"transporttaskquelle": "%WE%", "transporttaskziel": "%BGL%"}),
    TransportKpi(
        "we_bsf_ov", 2, {"transportrequestziel": "%BSF_O%"},
        {"transporttaskquelle": "WE", "lagbez": "Wareneingang"}),
)


@dataclass(frozen=True)
class Route:
    """A background transport counted against an order's window; None matches anything."""

    name: str
    from_place: str | None = None
    to_place: str | None = None
    carrier_type: str | None = None
    inclusive: bool = False


# --- Fixed values: statuses, carrier types and routes of the order analysis ---------
ORDER_CHANNEL = "OUTLET"
ORDER_FINALISING = "Finalisierung gestartet"
ORDER_DELETED = "Deleted"
REQUEST_CREATED = "Transportrequest erstellt"
REQUEST_STARTED = "Transportrequest gestartet"
REQUEST_DONE = "Transportrequest erledigt"
SHIPPING_TYPE = "Versand%"
PALLET_STATION = "PALAP%"
MIN_COLLI = 16
ROUTES = (
    Route("aklg_to_zu", "AKL_G", "ZU", "Outletbehälter"),
    Route("pall_to_vd", "PALL", "VD", "Outletbehälter"),
    Route("akl_to_pallpzu", "AKL", "PALLPZU", "Outletbehälter"),
    Route("aklg_to_ol", "AKL G", "OL", "Outletbehälter"),
    Route("gs_to_akl", "GS", "AKL", "Outletbehälter"),
    Route("any_to_akl", None, "AKL", "Outletbehälter"),
    Route("aklg_out", "AKL G", None, "Outletbehälter", inclusive=True),
    Route("akl_carton_out", "AKL", None, "Versandkarton", inclusive=True),
    Route("aklg_any_out", "AKL G", None, None, inclusive=True),
)

# --- Parameters of the remaining reports --------------------------------------------
NO_BRAND = "no brand info"
DPMI_LIMIT = 3500.0
TICKET_PREFIX = "TKT-"
FIRST_TICKET = 65
BOARD_PERIOD = "5 minutes"


@dataclass(frozen=True)
class MonthlyReport:
    """One monthly hand-over: row predicate, output columns in order, and their names."""

    name: str
    where: dict[str, str]
    # Column names of the hand-over.
    columns: dict[str, str] = field(default_factory=lambda: {
        "timestamp": "timestamp",
        "ean": "ean",
        "quality": "quality",
        "category": "category",
        "distribution_channel": "zielkanal",
        "reference_lhm": "reference_lhm",
        "brand_name": "brand_name",
    })


MONTHLY_REPORTS = {
    "monthly_zfs": MonthlyReport("monthly_zfs", {"reference_lhm": "Z%"}),
    "monthly_beauty": MonthlyReport("monthly_beauty", {"category": "Beauty", "quality": "B"}),
}
