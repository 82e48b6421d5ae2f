"""Word lists and labels that a three-category pack starts from.

Fixed values: they decide which documents are boosted, rescued or confirmed, so
results only agree when they are exactly these. Each entry is a regex fragment
matched as a whole word. The list of hard terms and the rule files are the
user's data and are not shipped.
"""

AMPLIFIERS = (
    "hina", "celaka", "bodoh", "gila", "jahat", "zalim", "busuk", "korup", "corrupt", "evil", "stupid",
    "idiot", "trash", "garbage", "fuck", "babi", "sial", "bangsat", "penipu", "liar", "kafir", "sesat",
    "destroy", "kill", "murder", "bunuh", "bakar", "hapus", "usir", "layang", "tendang",
)

SAFE_CONTEXT = (
    # news
    "berita", "laporan", "dilaporkan", "menurut", "kata beliau", "sumber", "agensi",
    "bernama", "astro awani", "the star", "nst", "utusan", "harian metro",
    "wartawan", "sidang media", "kenyataan akhbar", "press statement",
    "reported", "according to", "news", "journalist", "press conference",
    # research
    "kajian", "penyelidikan", "jurnal", "universiti", "profesor", r"dr\.",
    "thesis", "dissertation", "research", "study", "academic", "scholar", "findings",
    "analisis", "analysis", "data menunjukkan", "data shows",
    # history and education
    "sejarah", "bersejarah", "historical", "history", "peringatan",
    "commemorate", "memorial", "muzium", "museum", "dokumentari", "documentary",
    "pendidikan", "education", "kurikulum", "curriculum",
    # law and policy
    "perlembagaan", "constitution", "undang.?undang", "legislation",
    "parlimen", "parliament", "dewan rakyat", "dewan negara",
    "mahkamah", "court", "tribunal",
    # harmony
    "perpaduan", "keharmonian", "muhibbah", "toleransi",
    "unity", "harmony", "tolerance", "diversity", "inclusiv",
    "bersatu", "bersama.?sama", "kerjasama", "cooperation",
    "perayaan", "celebration", "sambutan", "meraikan",
    "menghormati", "respect", "hormati",
)

RACE_ENTITIES = (
    "melayu", "cina", "india", "iban", "kadazan", "dayak", "orang asli", "bumi",
    "bumiputera", "pendatang", "chinese", "malay", "indian", "ethnic", "racial", "kaum", "bangsa",
)

RACE_VERIFY_ENTITIES = (
    "melayu", "cina", "india", "iban", "kadazan", "dayak", "orang asli", "bumi",
    "bumiputera", "pendatang", "chinese", "malay", "indian", "kaum", "bangsa",
)

RELIGION_ENTITIES = (
    "islam", "muslim", "kristian", "christian", "hindu", "buddha", "sikh", "gereja",
    "masjid", "surau", "kuil", "tokong", "bible", "quran", "al-quran", "bible", "veda", "agama",
)

ROYALTY_ENTITIES = (
    "sultan", "raja", "agong", "ydpa", "diraja", "monarchy", "king", "queen", "putera",
    "puteri", "tengku", "tunku", "duli", "istana", "palace",
)

# Labels of a text-classification model that count as toxic.
TOXIC_LABELS = ("TOXIC", "SEVERE_TOXIC", "OBSCENE", "THREAT", "INSULT", "IDENTITY_HATE", "LABEL_1")

# Candidate labels of a zero-shot model.
RACE_LABEL = "racial hatred"
RELIGION_LABEL = "religious hatred"
ROYALTY_LABEL = "insult to royalty"
SAFE_LABEL = "safe content"
