"""Text rules for bank-transaction descriptions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The descriptions the underwriters look for, as regular expressions.
STOP_PAYMENT_ALTERNATIVES = [
    r"rtn\s+funds\s+held",
    r"Correction",
    r"User\s+Fees",
    r"Returned\s+Item\s+Stopped",
    r"RTN\s+NOT\s+AUTH",
    r"STOP\s+PAYMENT\s+FEE",
    r"RTN\s+STOP\s+PAYT",
]
NSF_ALTERNATIVES = [
    r"Cheque\s+returned\s+to\s+another\s+inst\s+NSF",
    r"\bNSF\b",
    r"Charge\s+returned\s+cheque",
    r"RTN\s+SPS",
    r"PAP\s+Return",
    r"RTN\s+FUNDS\s+HELD",
    r"Reversal",
    r"Effet\s+refus[eé]\s+sans\s+provision",
    r"NSF\s+return\s+Service\s+Charge",
    r"\s+Debit\s+Arrangement\s+AccountItem\s+returned\s+unpaid",
    r"CURRENT\s+CREDIT\s+ADJUSTMENT\s+EFT\s+REVERSAL",
    r"Internet\s+Banking\s+CORRECTION",
    r"returned\s+item\s+credit",
    r"Returned\s+(Item|cheque)[\s-]*NSF",
    r"AFT\s+Return\s+NSF",
    r"frais\s+opp\s+paiement",
    r"BR\.?0072",
]
LAWYER_ALTERNATIVES = [
    r"Boyle.Co",
    r"Bingham\s+Law",
    r"Duncan\s+Craig",
    r"Mackenzie\s+Morgan\s+law",
    r"Alberta\s+legal\s+Aid",
    r"Duchin[\s,]+Bayda[\s&]+Kroczynski\s+Law\s+Firm",
    r"Law\s+Society\s+of\s+Ontario",
    r"Aird[\s&]+Berlis",
    r"Fillmore\s+Riley",
    r"Stein\s+Monast",
    r"The\s+Advocates.Society",
]

STOP_PAYMENT, LAWYER, NSF = "stop_payment", "lawyer", "nsf"


def any_of(alternatives: list[str]) -> str:
    return "(" + "|".join(alternatives) + ")"


def matches(text: Column, alternatives: list[str]) -> Column:
    """Case-insensitive search; the U flag makes case, ``\\s`` and ``\\b`` follow Unicode (``REFUSÉ``)."""
    return text.rlike("(?iU)" + any_of(alternatives))


def is_stop_payment(text: Column) -> Column:
    return matches(text, STOP_PAYMENT_ALTERNATIVES)


def is_nsf(text: Column) -> Column:
    return matches(text, NSF_ALTERNATIVES)


def is_lawyer(text: Column) -> Column:
    return matches(text, LAWYER_ALTERNATIVES)


def is_classified(text: Column) -> Column:
    """Does any of the lists match? One search instead of three, for the many rows that none matches."""
    return matches(text, STOP_PAYMENT_ALTERNATIVES + LAWYER_ALTERNATIVES + NSF_ALTERNATIVES)


def transaction_class(text: Column) -> Column:
    """One class per description. The order matters: some descriptions fit two lists."""
    return (
        F.when(is_stop_payment(text), STOP_PAYMENT).when(is_lawyer(text), LAWYER).when(is_nsf(text), NSF)
    )


def without_punctuation(text: Column) -> Column:
    """Drop ASCII punctuation only; accented letters and typographic marks stay."""
    return F.regexp_replace(text, r"[!-/:-@\[-`{-~]", "")
