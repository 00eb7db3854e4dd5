"""Word lists that drive extraction and normalization.

Pass another :class:`Vocabulary` to the extraction functions to extend or replace them.
Alternatives are tried in the given order at each position of the text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from paperloom.functions.exprs import SPACE

# Names and patterns the results depend on.
LIPIDS = (
    "DLin-MC3-DMA",
    "MC3",
    "ALC-0315",
    "SM-102",
    rf"lipid{SPACE}*H",
    rf"ionizable{SPACE}+lipid",
    rf"cationic{SPACE}+lipid",
    "DSPC",
    "DOPE",
    "DOPC",
    "DPPC",
    "cholesterol",
    "Chol",
    "PEG-lipid",
    rf"PEGylated{SPACE}+lipid",
    "DMG-PEG",
    "ALC-0159",
    "C12-200",
    "DLinDMA",
    "DOTAP",
    "DOTMA",
)
RATIO_CUES = ("molar ratio", "mol/mol", "wt/wt", "weight ratio")
RATIO_TAIL = r"[^\n.;:]{0,120}"
PAYLOADS = (
    "mRNA",
    "siRNA",
    "saRNA",
    "plasmid DNA",
    "pDNA",
    "CRISPR",
    "sgRNA",
    "RNP",
    "antisense",
    "miRNA",
    "ASO",
)
ROUTES = (
    "intravenous(?:ly)?",
    "IV",
    "intraperitoneal(?:ly)?",
    "IP",
    "intramuscular(?:ly)?",
    "IM",
    "subcutaneous(?:ly)?",
    "SC",
    "intranasal(?:ly)?",
    "IN",
    "intratracheal(?:ly)?",
    "IT",
    "oral(?:ly)?",
    "topical(?:ly)?",
    "intratumoral(?:ly)?",
)
CELLS = (
    "HeLa",
    "HEK293",
    "HepG2",
    "A549",
    "Jurkat",
    "PBMC",
    "dendritic cell",
    "hepatocyte",
    "macrophage",
    "T cell",
    "B cell",
    "mouse",
    "mice",
    "rat",
    "rabbit",
    "NHP",
    "non-human primate",
    "human",
    "in vivo",
    "in vitro",
)
# Alias in lower case -> canonical name.
ALIASES = {
    "cationic lipid": "ionizable lipid",
    "peg lipid": "PEG-lipid",
    "pegylated lipid": "PEG-lipid",
    "chol": "cholesterol",
    "iv": "intravenous",
    "im": "intramuscular",
    "sc": "subcutaneous",
}


@dataclass(frozen=True)
class Vocabulary:
    lipids: tuple[str, ...] = LIPIDS
    ratio_cues: tuple[str, ...] = RATIO_CUES
    payloads: tuple[str, ...] = PAYLOADS
    routes: tuple[str, ...] = ROUTES
    cells: tuple[str, ...] = CELLS
    aliases: dict[str, str] = field(default_factory=lambda: dict(ALIASES))


DEFAULT_VOCABULARY = Vocabulary()
