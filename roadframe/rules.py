"""Rule documents and fixed domains.

Everything below the marker is a FIXED VALUE: it must equal the published
accident-data coding so that recoded tables keep their meaning. The values
are kept as plain data, in their natural order; the code that uses them
(``roadframe.functions.recode``) only reads them.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — category recode rules.
# column -> {"dtype": final type, "modalities": {label: [codes]},
#            "to_nan": [codes that mean "unknown" and become -1]}
# ---------------------------------------------------------------------------
RECODE_RULES: dict[str, dict] = {
    "lum": {"dtype": "category",
            "modalities": {"jour": ["1"], "crepuscule_aube": ["2"], "nocturne": ["3", "4", "5"]},
            "to_nan": ["-1"]},
    "atm": {"dtype": "category",
            "modalities": {"normale": ["1", "8"], "pluvieuses": ["2", "3"],
                           "difficiles": ["4", "5", "6", "7", "9"]},
            "to_nan": ["-1"]},
    "col": {"dtype": "category",
            "modalities": {"sans_collision": ["7"], "deux_vl": ["1", "2", "3"], "autres": ["4", "5", "6"]},
            "to_nan": ["-1"]},
    "catr": {"dtype": "category",
             "modalities": {"route_principale": ["1", "2"], "route_secondaire": ["3", "4"],
                            "route_urbaine": ["7"], "autre": ["5", "6", "9"]}},
    "circ": {"dtype": "category",
             "modalities": {"simple": ["1", "2"], "complexe": ["3", "4"]},
             "to_nan": ["-1"]},
    "vosp": {"dtype": "category",
             "modalities": {"sans": ["0"], "avec": ["1", "2", "3"]},
             "to_nan": ["-1"]},
    "prof": {"dtype": "category",
             "modalities": {"plat": ["1"], "incline": ["2", "3", "4"]},
             "to_nan": ["-1"]},
    "plan": {"dtype": "category",
             "modalities": {"rectiligne": ["1"], "courbe": ["2", "3", "4"]},
             "to_nan": ["-1"]},
    "surf": {"dtype": "category",
             "modalities": {"normale": ["1"], "humide": ["2", "3", "4"], "autre": ["5", "6", "7", "8", "9"]},
             "to_nan": ["-1"]},
    "infra": {"dtype": "category",
              "modalities": {"aucun": ["0"], "routiers": ["1", "2", "3", "5"], "zones": ["4", "6", "7", "8", "9"]},
              "to_nan": ["-1"]},
    "situ": {"dtype": "category",
             "modalities": {"aucun": ["0"], "normale": ["1"], "particuliere": ["2", "3", "4", "5", "6", "8"]},
             "to_nan": ["-1"]},
    "place": {"dtype": "category",
              "modalities": {"conducteur": ["1"], "pieton": ["10"], "passager_avant": ["6", "2"],
                             "passager": ["3", "4", "5", "7", "8", "9"]},
              "to_nan": ["-1"]},
    "trajet": {"dtype": "category",
               "modalities": {"domicile": ["1", "2"], "personnelle": ["3", "5"],
                              "professionnelle": ["4"], "autre": ["9"]},
               "to_nan": ["0", "-1"]},
    "locp": {"dtype": "category",
             "modalities": {"sans": ["0"], "chaussee": ["1", "2", "3", "4"], "autre": ["5", "6", "7", "8"]},
             "to_nan": ["-1", "9"]},
    "senc": {"dtype": "category",
             "modalities": {"croissant": ["1"], "decroissant": ["2"], "inconnu": ["0", "3"]},
             "to_nan": ["-1"]},
    "catv": {"dtype": "category",
             "modalities": {"cycle_edp": ["1", "50", "60", "80"],
                            "2rm": ["2", "30", "31", "32", "33", "34"],
                            "vl": ["3", "7", "10", "35", "36", "41", "42", "43"],
                            "pl": ["13", "14", "15", "16", "17", "20", "21", "37", "38", "39", "40", "99"]},
             "to_nan": ["-1", "0"]},
    "obs": {"dtype": "category",
            "modalities": {"aucun": ["0"],
                           "structurel": ["1", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12",
                                          "14", "16", "15", "17"],
                           "naturel": ["2", "13"]},
            "to_nan": ["-1"]},
    "obsm": {"dtype": "category",
             "modalities": {"aucun": ["0"], "pieton": ["1"], "vehicule": ["2", "4"], "autre": ["5", "6", "9"]},
             "to_nan": ["-1"]},
    "agg": {"dtype": "int64",
            "modalities": {"0": ["1"], "1": ["2"]}},
    "int": {"dtype": "category",
            "modalities": {"aucun": ["1"], "simple": ["2", "3", "4"], "complexe": ["5", "6", "7", "8", "9"]},
            "to_nan": ["-1"]},
    "sexe": {"dtype": "category",
             "modalities": {"masculin": ["1"], "feminin": ["2"]},
             "to_nan": ["-1"]},
    "manv": {"dtype": "category",
             "modalities": {"ligne_droite": ["1", "2"],
                            "atypique": ["3", "5", "6", "7", "8", "9", "25"],
                            "changement_dir": ["10", "11", "12", "13", "14", "15", "16", "17", "18"],
                            "particuliere": ["4", "19", "21", "22", "26"],
                            "arret": ["20", "23", "24"]},
             "to_nan": ["-1", "0"]},
    "actp": {"dtype": "category",
             "modalities": {"axe": ["1", "2"], "traverse": ["3"], "autre": ["4", "5", "6", "A", "9", "7", "8"],
                            "sans_objet": ["0"]},
             "to_nan": ["-1", "B", " -1"]},
    "catu": {"dtype": "category",
             "modalities": {"pieton": ["3"], "en_vehicule": ["1", "2"]}},
}

# ---------------------------------------------------------------------------
# FIXED VALUES — membership flags.
# Safety equipment: flag -> codes looked up in secu1, secu2, secu3.
# Impact point: flag -> codes of the single column choc.
# Vehicle classes that get an "other involved" indicator.
# Target collapse: grav 4 -> 1, 3 -> 2, drop -1, then minus 1.
# ---------------------------------------------------------------------------
SECU_FLAGS: dict[str, list[int]] = {
    "has_ceinture": [1],
    "has_gants": [6, 7],
    "has_casque": [2],
    "has_airbag": [5, 7],
    "has_gilet": [4],
    "has_de": [3],
}
SECU_COLUMNS = ["secu1", "secu2", "secu3"]

CHOC_FLAGS: dict[str, list[int]] = {
    "choc_avant": [1, 2, 3, 9],
    "choc_arriere": [4, 5, 6, 9],
    "choc_gauche": [3, 6, 8, 9],
    "choc_droit": [2, 5, 7, 9],
}

VEHICLE_CLASSES = ["cycle_edp", "2rm", "vl", "pl"]

GRAV_COLLAPSE = {4: 1, 3: 2}
GRAV_DROP = -1
GRAV_SHIFT = 1

# ---------------------------------------------------------------------------
# FIXED VALUES — pipeline configuration of the original data set.
# ---------------------------------------------------------------------------
PREFIXES = ["caracteristiques", "lieux", "usagers", "vehicules"]
YEARS_TO_PROCESS = [2019, 2020, 2021, 2022]
OLDEST_YEAR = 1910
VMA_CAP = 130
ENCODINGS = ["utf-8", "latin1", "ISO-8859-1"]
FEATURES_TO_DROP: dict[str, list[str]] = {
    "caracteristiques": ["com", "adr", "lat", "long"],
    "lieux": ["voie", "v1", "v2", "larrout", "pr", "pr1", "nbv"],
    "usagers": ["etatp"],
    "vehicules": ["occutc", "motor", "senc"],
}
KEY_COLUMNS_DROPPED = ["num_veh", "num_veh_x", "num_veh_y", "id_usager", "id_vehicule", "Num_Acc"]
TRAINING_DROPPED = ["an", "tpc", "an_nais"]
# file name: {prefix}_{year}.csv up to this year, {prefix}-{year}.csv after
UNDERSCORE_UNTIL_YEAR = 2016

# ---------------------------------------------------------------------------
# FIXED VALUES — the 46 model features in scoring order.
# ---------------------------------------------------------------------------
REQUIRED_COLUMNS = [
    "place", "catu", "sexe", "trajet", "locp", "actp", "catv", "obs",
    "obsm", "manv", "jour", "mois", "lum", "agg", "int", "atm", "col",
    "catr", "circ", "vosp", "prof", "plan", "surf", "infra", "situ", "vma",
    "nb_v", "nb_u", "imply_cycle_edp", "imply_2rm", "imply_vl", "imply_pl",
    "age", "jour_semaine", "hr", "reg", "has_ceinture", "has_gants",
    "has_casque", "has_airbag", "has_gilet", "has_de", "choc_avant",
    "choc_arriere", "choc_gauche", "choc_droit",
]

# ---------------------------------------------------------------------------
# FIXED VALUES — feature dictionary: type, form group, domain.
# numerical -> [min, max]; categorial -> allowed labels (first = default).
# ---------------------------------------------------------------------------
_REGIONS_LABELS = [
    "Ile-de-France", "Normandie", "Grand Est", "Nouvelle-Aquitaine", "Hauts-de-France", "Bretagne",
    "Occitanie", "Auvergne-Rhône-Alpes", "Provence-Alpes-Côte d'Azur", "Pays de la Loire",
    "Centre-Val de Loire", "Nouvelle-Calédonie", "Guadeloupe", "Martinique", "Mayotte", "La Réunion",
    "Bourgogne-Franche-Comté", "Corse", "Guyane", "Polynésie Française", "Saint-Pierre-et-Miquelon",
    "Saint-Barthélemy", "Saint-Martin", "Wallis-et-Futuna",
]
FEATURE_DICTIONARY: dict[str, dict] = {
    "place": {"type": "categorial", "group": "usager",
              "values": ["conducteur", "pieton", "passager", "passager_avant"]},
    "catu": {"type": "categorial", "group": "usager", "values": ["en_vehicule", "pieton"]},
    "sexe": {"type": "categorial", "group": "usager", "values": ["masculin", "feminin"]},
    "trajet": {"type": "categorial", "group": "usager",
               "values": ["personnelle", "domicile", "professionnelle", "autre"]},
    "locp": {"type": "categorial", "group": "usager", "values": ["sans", "chaussee", "autre"]},
    "actp": {"type": "categorial", "group": "usager", "values": ["sans_objet", "traverse", "autre", "axe"]},
    "catv": {"type": "categorial", "group": "vehicule", "values": ["vl", "2rm", "cycle_edp", "pl"]},
    "obs": {"type": "categorial", "group": "vehicule", "values": ["aucun", "naturel", "structurel"]},
    "obsm": {"type": "categorial", "group": "vehicule", "values": ["aucun", "vehicule", "pieton", "autre"]},
    "manv": {"type": "categorial", "group": "vehicule",
             "values": ["ligne_droite", "changement_dir", "particuliere", "atypique", "arret"]},
    "jour": {"type": "numerical", "group": "contexte", "values": [1, 31]},
    "mois": {"type": "numerical", "group": "contexte", "values": [1, 12]},
    "lum": {"type": "categorial", "group": "contexte", "values": ["jour", "crepuscule_aube", "nocturne"]},
    "agg": {"type": "numerical", "group": "contexte", "values": [0, 1]},
    "int": {"type": "categorial", "group": "contexte", "values": ["aucun", "simple", "complexe"]},
    "atm": {"type": "categorial", "group": "contexte", "values": ["normale", "difficiles", "pluvieuses"]},
    "col": {"type": "categorial", "group": "autre", "values": ["deux_vl", "autres", "sans_collision"]},
    "catr": {"type": "categorial", "group": "contexte",
             "values": ["route_secondaire", "route_urbaine", "autre", "route_principale"]},
    "circ": {"type": "categorial", "group": "contexte", "values": ["simple", "complexe"]},
    "vosp": {"type": "categorial", "group": "contexte", "values": ["sans", "avec"]},
    "prof": {"type": "categorial", "group": "contexte", "values": ["plat", "incline"]},
    "plan": {"type": "categorial", "group": "contexte", "values": ["rectiligne", "courbe"]},
    "surf": {"type": "categorial", "group": "contexte", "values": ["normale", "humide", "autre"]},
    "infra": {"type": "categorial", "group": "contexte", "values": ["aucun", "routiers", "zones"]},
    "situ": {"type": "categorial", "group": "contexte", "values": ["normale", "particuliere"]},
    "vma": {"type": "numerical", "group": "contexte", "values": [0, 130]},
    "nb_v": {"type": "numerical", "group": "contexte", "values": [1, 25]},
    "nb_u": {"type": "numerical", "group": "contexte", "values": [1, 39]},
    "age": {"type": "numerical", "group": "usager", "values": [0, 110]},
    "jour_semaine": {"type": "categorial", "group": "contexte",
                     "values": ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]},
    "hr": {"type": "numerical", "group": "contexte", "values": [0, 23]},
    "reg": {"type": "categorial", "group": "contexte", "values": _REGIONS_LABELS},
    "has_ceinture": {"type": "numerical", "group": "usager", "values": [0, 1]},
    "has_gants": {"type": "numerical", "group": "usager", "values": [0, 1]},
    "has_casque": {"type": "numerical", "group": "usager", "values": [0, 1]},
    "has_airbag": {"type": "numerical", "group": "usager", "values": [0, 1]},
    "has_gilet": {"type": "numerical", "group": "usager", "values": [0, 1]},
    "has_de": {"type": "numerical", "group": "usager", "values": [0, 1]},
    "choc_avant": {"type": "numerical", "group": "vehicule", "values": [0, 1]},
    "choc_arriere": {"type": "numerical", "group": "vehicule", "values": [0, 1]},
    "choc_gauche": {"type": "numerical", "group": "vehicule", "values": [0, 1]},
    "choc_droit": {"type": "numerical", "group": "vehicule", "values": [0, 1]},
    "imply_cycle_edp": {"type": "numerical", "group": "contexte", "values": [0, 1]},
    "imply_2rm": {"type": "numerical", "group": "contexte", "values": [0, 1]},
    "imply_vl": {"type": "numerical", "group": "contexte", "values": [0, 1]},
    "imply_pl": {"type": "numerical", "group": "contexte", "values": [0, 1]},
}

# ---------------------------------------------------------------------------
# FIXED VALUES — department -> region lookup (departement,region), 107 rows.
# ---------------------------------------------------------------------------
REGIONS_CSV = """departement,region
01,Auvergne-Rhône-Alpes
02,Hauts-de-France
03,Auvergne-Rhône-Alpes
04,Provence-Alpes-Côte d'Azur
05,Provence-Alpes-Côte d'Azur
06,Provence-Alpes-Côte d'Azur
07,Auvergne-Rhône-Alpes
08,Grand Est
09,Occitanie
10,Grand Est
11,Occitanie
12,Occitanie
13,Provence-Alpes-Côte d'Azur
14,Normandie
15,Auvergne-Rhône-Alpes
16,Nouvelle-Aquitaine
17,Nouvelle-Aquitaine
18,Centre-Val de Loire
19,Nouvelle-Aquitaine
2A,Corse
2B,Corse
21,Bourgogne-Franche-Comté
22,Bretagne
23,Nouvelle-Aquitaine
24,Nouvelle-Aquitaine
25,Bourgogne-Franche-Comté
26,Auvergne-Rhône-Alpes
27,Normandie
28,Centre-Val de Loire
29,Bretagne
30,Occitanie
31,Occitanie
32,Occitanie
33,Nouvelle-Aquitaine
34,Occitanie
35,Bretagne
36,Centre-Val de Loire
37,Centre-Val de Loire
38,Auvergne-Rhône-Alpes
39,Bourgogne-Franche-Comté
40,Nouvelle-Aquitaine
41,Centre-Val de Loire
42,Auvergne-Rhône-Alpes
43,Auvergne-Rhône-Alpes
44,Pays de la Loire
45,Centre-Val de Loire
46,Occitanie
47,Nouvelle-Aquitaine
48,Occitanie
49,Pays de la Loire
50,Normandie
51,Grand Est
52,Grand Est
53,Pays de la Loire
54,Grand Est
55,Grand Est
56,Bretagne
57,Grand Est
58,Bourgogne-Franche-Comté
59,Hauts-de-France
60,Hauts-de-France
61,Normandie
62,Hauts-de-France
63,Auvergne-Rhône-Alpes
64,Nouvelle-Aquitaine
65,Occitanie
66,Occitanie
67,Grand Est
68,Grand Est
69,Auvergne-Rhône-Alpes
70,Bourgogne-Franche-Comté
71,Bourgogne-Franche-Comté
72,Pays de la Loire
73,Auvergne-Rhône-Alpes
74,Auvergne-Rhône-Alpes
75,Ile-de-France
76,Normandie
77,Ile-de-France
78,Ile-de-France
79,Nouvelle-Aquitaine
80,Hauts-de-France
81,Occitanie
82,Occitanie
83,Provence-Alpes-Côte d'Azur
84,Provence-Alpes-Côte d'Azur
85,Pays de la Loire
86,Nouvelle-Aquitaine
87,Nouvelle-Aquitaine
88,Grand Est
89,Bourgogne-Franche-Comté
90,Bourgogne-Franche-Comté
91,Ile-de-France
92,Ile-de-France
93,Ile-de-France
94,Ile-de-France
95,Ile-de-France
971,Guadeloupe
972,Martinique
973,Guyane
974,La Réunion
975,Saint-Pierre-et-Miquelon
976,Mayotte
977,Saint-Barthélemy
978,Saint-Martin
987,Polynésie Française
986,Wallis-et-Futuna
988,Nouvelle-Calédonie
"""


def validate_rules(rules: dict[str, dict]) -> list[str]:
    """Check that one-pass recoding equals sequential per-label replacement.

    Sequential replacement would re-match a produced label if that label is
    also an old code of a *later* label of the same column. Returns the
    offending ``column:label`` strings (empty = safe to compile in one pass).
    """
    problems = []
    for col, spec in rules.items():
        labels = list(spec.get("modalities", {}).items())
        for i, (label, _codes) in enumerate(labels):
            for later_label, later_codes in labels[i + 1:]:
                if label in [str(c) for c in later_codes]:
                    problems.append(f"{col}:{label}->{later_label}")
    return problems
