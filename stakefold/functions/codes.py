"""Code tables and decode expressions of the domain.

The literal values below are fixed by the source systems' data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
HORSE, FOUR_D, POOL, SWEEP, SPORTS, SPORTS_LIVE = 1, 2, 3, 4, 5, 6
HOST_LOTTERY, HOST_HORSE, HOST_SPORTS = 1, 2, 3

NAME_HORSE = "HORSE RACING"
NAME_4D = "4D Lottery"
NAME_POOL = "TOTO"
NAME_MATCH = "TOTO MATCH"
NAME_SWEEP = "SINGAPORE SWEEP"
NAME_SPORTS = "SPORTS"

MATCH_BET_TYPES = ["M AN", "M 2", "M 3", "M 4"]
PAYMENT_SUCCESS = {"PNQR": ["01"], "PNRIC": ["01", "03", "04"]}
NO_GROUP = "00000000-0000-0000-0000-000000000000"
TWO_WAY = "W-P"

RETAILER_TYPES = [2, 4]
BRANCH_TYPE = 1

PRODUCT_CODES = {1: 7, 2: 9, 3: 23, 4: 11, 5: 20, 6: 20}
ENTRY_METHODS = {"MANUAL": 0, "BETSLIP": 2, "EDIT": 10, "EBETSLIP": 16}
POOL_BET_CODES = {
    "ORD": "0", "SYSR": "1", "SYS7": "2", "SYS8": "3", "SYS9": "4", "SYS10": "5",
    "SYS11": "6", "SYS12": "7", "M 4": "16", "M 3": "17", "M 2": "18", "M AN": "19",
}
POOL_SIMPLE_BETS = {
    "ORD": 1, "SYSR": 44, "SYS7": 7, "SYS8": 28, "SYS9": 84, "SYS10": 210,
    "SYS11": 462, "SYS12": 924, "M 4": 1, "M 3": 1, "M 2": 1, "M AN": 1,
}
SPORTS_BET_CODES = {"ACC4": "4F", "DBL": "D", "SGL": "S", "TBL": "T"}
# first code of a 4D family, per stake side: big only, small only, both
FOUR_D_PLAIN = {"big": 0, "small": 5, "both": 10}
FOUR_D_SYSTEM = {"big": 1, "small": 6, "both": 11}
FOUR_D_IBET = {"big": 27, "small": 31, "both": 35}
FOUR_D_ROLL = {"big": 15, "small": 19, "both": 23}
PERMUTATION_STEP = {24: 0, 12: 1, 4: 2, 6: 3}
# ----------------------------------------------------------------------------


def lookup(key: Column, table: dict, default=None) -> Column:
    """Map codes through a literal table; anything else gives ``default``."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def is_match_bet(bet_type: Column) -> Column:
    return bet_type.isin(*MATCH_BET_TYPES)


def bet_status(rejected: Column, cancelled: Column, exchanged: Column) -> Column:
    """Ticket state 1..6: 1 live, 2 cancelled, 3 rejected, 4 both, 6 exchange, 5 anything else."""
    rej = F.coalesce(rejected, F.lit(False))
    plain = ~exchanged
    return (
        F.when(~rej & ~cancelled & plain, 1)
        .when(~rej & cancelled & plain, 2)
        .when(rej & ~cancelled & plain, 3)
        .when(rej & cancelled & plain, 4)
        .when(~rej & ~cancelled & exchanged, 6)
        .otherwise(5)
    )


def sweep_counts(state: Column, printed: Column, indicator: Column) -> Column:
    """Printed tickets (or plain shops) count when placed; unprinted consignee tickets when taken."""
    held = printed.isNull() & indicator.isNotNull()
    return ((state == "PB06") & ~held) | ((state == "PB03") & held)


def four_d_bet_code(bet_type: Column, big: Column, small: Column, permutation: Column, number: Column) -> Column:
    """4D bet code from family, staked sides, permutation count or roll position."""
    b, s = F.coalesce(big, F.lit(0)) > 0, F.coalesce(small, F.lit(0)) > 0
    side = F.when(b & ~s, "big").when(~b & s, "small").when(b & s, "both")
    step = lookup(permutation, PERMUTATION_STEP)
    at = F.instr(number, "R")
    roll = F.when(at.between(1, 3), at - 1).otherwise(3)
    code = (
        F.when(bet_type == "ORD", lookup(side, FOUR_D_PLAIN))
        .when(bet_type == "SYS", lookup(side, FOUR_D_SYSTEM) + step)
        .when(bet_type == "IBET", lookup(side, FOUR_D_IBET) + step)
        .when(bet_type == "ROLL", lookup(side, FOUR_D_ROLL) + roll)
    )
    return code.cast("string")


def entry_method(col: Column) -> Column:
    return lookup(F.upper(col), ENTRY_METHODS)


def display_product(prodid: Column, name: Column) -> Column:
    """Both sports products are reported under one name."""
    return F.when(prodid.isin(SPORTS, SPORTS_LIVE), NAME_SPORTS).otherwise(F.trim(name))


def any_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a | b, conds)
