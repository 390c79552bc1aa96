"""Word lists of the normalisation rules."""

# Results depend on these words and their canonical forms.
LEGAL_FORMS = {
    "inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp", "co": "company", "company": "company",
    "llc": "llc", "ltd": "limited", "limited": "limited", "pvt": "private", "private": "private", "llp": "llp",
    "plc": "plc", "pc": "pc", "sa": "sa", "sas": "sas", "sasu": "sas", "sarl": "sarl", "eurl": "eurl", "snc": "snc",
    "sci": "sci", "societe": "societe", "ste": "societe", "groupe": "group", "group": "group",
}
ADDRESS_ABBREVIATIONS = {
    "st": "street", "str": "street", "street": "street", "rd": "road", "road": "road", "ave": "avenue", "av": "avenue",
    "avenue": "avenue", "blvd": "boulevard", "bd": "boulevard", "boulevard": "boulevard", "ln": "lane", "lane": "lane",
    "dr": "drive", "drive": "drive", "ct": "court", "court": "court", "r": "rue", "rue": "rue", "chem": "chemin",
    "chemin": "chemin", "imp": "impasse", "impasse": "impasse", "rte": "route", "route": "route", "apt": "apartment",
    "apartment": "apartment", "unit": "unit", "fl": "floor", "floor": "floor", "dist": "district", "distt": "district",
    "district": "district", "nagar": "nagar", "marg": "marg", "colony": "colony",
}
STOP_TOKENS = (
    "the", "and", "of", "for", "in", "at", "near", "opp", "opposite", "behind", "next", "to", "null", "na", "n", "no",
    "le", "la", "les", "l", "de", "du", "des", "un", "une", "et", "a", "au", "aux", "en", "sur", "dans", "pour", "par",
    "avec", "chez",
)
LANDMARK_TOKENS = ("near", "opp", "opposite", "behind", "beside", "next", "front")
SOUNDEX_LETTERS = "abcdefghijklmnopqrstuvwxyz"
SOUNDEX_CODES = "01230120022455012623010202"
