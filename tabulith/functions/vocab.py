"""Vocabularies of the layout operators."""

# Title patterns by type, in order of precedence.
SCHEDULE_TITLES = {
    "beam_schedule": (r"schedule\s+of\s+beams?", r"beam\s+schedule", r"schedule\s+of\s+slab\s*beam"),
    "slab_schedule": (r"schedule\s+of\s+slabs?", r"slab\s+schedule"),
    "column_schedule": (r"schedule\s+of\s+columns?", r"column\s+schedule"),
    "reinforcement_schedule": (r"reinforcement\s+schedule", r"schedule\s+of\s+reinforcement"),
    "bar_bending_schedule": (r"bar\s+bending\s+schedule", r"\bbbs\b"),
    "material_schedule": (r"material\s+schedule", r"schedule\s+of\s+materials?"),
    "bill_of_materials": (r"bill\s+of\s+material", r"\bbom\b"),
    "weight_schedule": (r"weight\s+schedule",),
    "insert_schedule": (r"insert\s+schedule",),
    "dowel_bar_schedule": (r"dowel\s+bar\s+schedule",),
}
EXCLUDED_TITLES = (r"revision\s+schedule",)
NOTES_TITLES = {"general_notes": (r"general\s+notes?:?",), "legend": (r"legends?:?",), "specifications": (r"specifications?:?",)}

# Texts, lower case, with which a title block begins.
TITLE_BLOCK_STOPS = (r"^client:?$", r"^project:?$", r"^revision\s+schedule", r"^structural\s+consultant", r"^drawing\s+title")

# Canonical fields and the header texts that stand for them, lower case.
HEADER_ALIASES = {
    "beam_mark": ("beam mkd", "beam mkd.", "beam mark", "beam no", "mark"),
    "beam_size": ("beam size", "size", "b x d", "bxd", "width x depth"),
    "top_reinforcement": ("top reinfo", "top reinfo.", "top reinforcement", "top steel", "top bars"),
    "bottom_reinforcement": ("bottam reinfo", "bottam reinfo.", "bottom reinfo", "bottom reinfo.", "bottom reinforcement", "bot reinforcement", "bot reinfo", "bot steel", "bottom bars"),
    "straight_bars": ("str", "str.", "straight", "straight bars"),
    "bent_bars": ("bent", "bent bars", "bent up bars", "cranked"),
    "stirrups": ("stirrups", "stirrup", "shear links", "links", "shear reinforcement"),
    "spacing": ("spacing", "c/c", "c/c spacing"),
    "span": ("span", "clear span", "effective span"),
    "remarks": ("remarks", "remark", "note", "notes"),
    "slab_mark": ("slab mkd", "slab mkd.", "slab mark", "slab no", "panel"),
    "slab_thickness": ("thickness", "slab thickness", "depth"),
    "main_reinforcement": ("main reinfo", "main reinfo.", "main reinforcement", "main bars", "main steel"),
    "distribution_bars": ("dist", "dist.", "distribution", "distribution bars", "dist steel"),
    "column_mark": ("column mkd", "column mkd.", "column mark", "col mark", "col no"),
    "column_size": ("column size", "col size", "section"),
    "ref_no": ("ref no", "ref no.", "reference", "reference no", "ref"),
    "type": ("type",),
    "count": ("count", "qty", "quantity", "nos", "no."),
    "bar_diameter": ("bar diameter", "dia", "diameter", "bar dia", "bar size"),
    "volume": ("volume", "vol"),
    "weight": ("weight", "wt", "wt."),
    "length": ("length", "len", "bar length"),
}

# Canonical fields whose cells hold cell notations.
NOTATION_FIELDS = ("top_reinforcement", "bottom_reinforcement", "straight_bars", "bent_bars", "stirrups", "main_reinforcement", "distribution_bars", "spacing", "bar_diameter")

# Header texts that speak for a table, and against it.
ALLOW = {
    "schedule_headers": ("Ref No.", "Type", "Count", "Bar Diameter", "Volume", "Weight"),
    "notes_structural_cues": ("GRADE OF CONCRETE", "GRADE OF STEEL", "COVER", "LEGENDS", "ALL DIMENSIONS ARE IN MM"),
}
DENY = {"title_block_admin": ("Rev", "Date", "Description", "Chkd", "Appd", "Drawn By", "Job No", "Sheet No", "Scale", "Drawing Title", "Element No", "Structural Consultant", "Client", "Project")}

# Cell notations, the first that is found decides.
DIAMETER_SPACING = r"(?i)(\d+(?:\.\d+)?)\s*(?:[Øø]|\bdia\b)\s*(\d+)\s*C\s*/\s*C"
TYPE_SPACING = r"(?i)([A-Za-z]+\d+)\s*@\s*(\d+)\s*C\s*/\s*C"
COUNT_DIAMETER = r"(?i)(?:(\d+)\s*-\s*)?(\d+(?:\.\d+)?)\s*(?:[Øø]|\bdia\b)"
COUNT_TYPE = r"(?i)(\d+)\s*-\s*([A-Za-z]+\d+)"
MILLIMETRES = r"(?i)(?:(\d+)\s*-\s*)?(\d+(?:\.\d+)?)\s*mm\b"

# Weights of the signals, and least scores.
WEIGHTS = {"structure_found": 40, "allow_list": 45, "deny_list": -70, "inside_title_block": -30, "nearby_title": 15, "shape_sanity": 10}
CONFIDENCE_THRESHOLD = 50
FUZZY_THRESHOLD = 85
