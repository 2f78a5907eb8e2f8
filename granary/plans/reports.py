"""The sheets that leads are published in; titles may repeat, so columns are ordered here and named at the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RULES, Rules
from ..operators.facts import debt_ceiling, pivot_facts
from ..operators.leads import first_lines, line_columns, structured_lines, wide_1year
from ..operators.lines import credit_institution_lines
from .storage import keep

# fixed values: the columns of the published sheets, in their order
CONTACTS = {
    "ICP_Score": "icp_score", "ICP_Reasons": "icp_reasons", "OrgNr": "org", "Name": "name", "Email": "email", "Phone": "phone", "Is_AB": "is_ab", "Reg_Year": "reg_year",
    "Company_Age": "company_age", "Employees": "employees", "Branch": "branch", "Branch_Segment": "branch_segment", "SNI_Code": "sni_code", "Omsattning_SEK": "revenue",
    "Omsattning_Year": "revenue_year", "Rorelseresultat_SEK": "operating_result", "Arets_Resultat_SEK": "net_result", "Kortfristiga_Skulder_SEK": "short_debt",
    "Langfristiga_Skulder_SEK": "long_debt", "Lender_Keywords": "lender_keywords",
}
CONTACT_LINES = (("Keyword_Line_1", "l1"), ("Recent_Year_Value", "l1_n1"), ("Previous_Year_Value", "l1_n2"), ("Keyword_Line_2", "l2"), ("Recent_Year_Value", "l2_n1"), ("Previous_Year_Value", "l2_n2"))
PERSON = {"OrgNr": "org", "Name": "name", "Email": "email", "Phone": "phone", "Pdf_Lender_Keywords": "lender_keywords"}
WIDE_LINES = tuple((f"Kreditinstitut_L{n}{title}", f"l{n}{column}") for n in (1, 2) for title, column in (("", ""), ("_Idx", "_idx"), ("_N1", "_n1"), ("_N2", "_n2")))


def _of(df: DataFrame, columns) -> DataFrame:
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(f"c{i}") for i, c in enumerate(columns)])


def _items(lines: DataFrame) -> DataFrame:
    """lines (org, seq, key, line, values, and pos or line_idx) as structured_lines() takes them."""
    place = F.col("line_idx") if "line_idx" in lines.columns else F.col("pos")
    return lines.withColumns({"pos": F.col("pos") if "pos" in lines.columns else place, "idx": F.col("idx") if "idx" in lines.columns else place})


def contacts(leads: DataFrame, lines: DataFrame, rules: Rules = RULES) -> tuple[DataFrame, tuple[str, ...]]:
    """(26 columns, best leads first; their titles). Values of lines beyond the org's debt ceiling are blank."""
    leads = keep(leads)  # read for the ceilings and for the sheet
    ceilings = leads.select("org", debt_ceiling(F.col("short_debt"), F.col("long_debt"), rules).alias("ceiling"))
    cells = line_columns(structured_lines(_items(lines), ceilings))
    ranked = leads.drop(*[c for c in cells.columns if c != "org"]).join(cells, "org", "left").orderBy(F.desc("icp_score"), "first_seq")
    return _of(ranked, [*CONTACTS.values(), *[c for _, c in CONTACT_LINES]]), (*CONTACTS, *[t for t, _ in CONTACT_LINES])


def wide(leads: DataFrame, lines: DataFrame, stored: DataFrame | None = None) -> tuple[DataFrame, tuple[str, ...]]:
    """(15 columns; their titles): who, all keyword lines and all credit institution lines of the first observation
    that has some, and the first two in parts. stored: credit lines that observations already hold."""
    items = _items(lines)
    debts = credit_institution_lines(items, None if stored is None else _items(stored))
    joined = leads.drop("every_line", "debt_lines").join(first_lines(items, "every_line"), "org", "left").join(first_lines(debts, "debt_lines"), "org", "left")
    cells = wide_1year(items)
    joined = joined.drop(*[c for c in cells.columns if c != "org"]).join(cells, "org", "left")
    return _of(joined, [*PERSON.values(), "every_line", "debt_lines", *[c for _, c in WIDE_LINES]]), (*PERSON, "Pdf_Lender_Keyword_Lines", "Kreditinstitut_Skulder_Lines", *[t for t, _ in WIDE_LINES])


def pivot(leads: DataFrame, best: DataFrame, labels: list[str]) -> tuple[DataFrame, tuple[str, ...]]:
    """(who, then value and year of each label; titles, of which the year's repeats)."""
    joined = leads.join(pivot_facts(best, labels), "org")
    cells = [c for i in range(1, len(labels) + 1) for c in (f"v{i}", f"y{i}")]
    return _of(joined, [*PERSON.values(), *cells]), (*PERSON, *[t for label in labels for t in (label, "År")])
