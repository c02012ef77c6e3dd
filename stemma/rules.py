"""Vocabularies and ordered rule tables, as data.

Everything here is in the same Unicode form (NFC) as cleaned text, because a word typed with a precomposed letter would
never match otherwise. Patterns are written for Java's regular expressions, where the engine runs them.
"""

from __future__ import annotations

import unicodedata


def nfc(text: str) -> str:
    return unicodedata.normalize("NFC", text)


def _words(*words: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(map(nfc, words)))


def _table(**pairs: str) -> dict[str, str]:
    return {nfc(k): v for k, v in pairs.items()}


# ---------- fixed values: characters ----------
BN_BLOCK = "ঀ-৿"
BN_LETTERS = "ঀ-৥ৰ-৿"
BN_DIGITS = "০১২৩৪৫৬৭৮৯"
JOINERS = "‌‍"
CONSONANT = "[\u0995-\u09b9\u09dc\u09dd\u09df\u09ce]"
HASANTA, NUKTA = "\u09cd", "\u09bc"

# ---------- fixed values: titles ----------
BINDING = _table(paperback="paperback", hardcover="hardcover", হার্ডকভার="hardcover", পেপারব্যাক="paperback")
PAPER = _table(সাদা="white", নিউজ="newsprint", অফসেট="offset")
LANGUAGE = _table(বাংলা="bn", ইংরেজি="en", ইংলিশ="en", english="en", bangla="bn", bengali="bn")
BUNDLE_MARKERS = _words("রকমারি কালেকশন", "প্যাকেজ", "সেট", "কম্বো", "বক্স সেট", "Box Set", "Combo", "Package")
COLLECTION_WORDS = _words("সমগ্র", "রচনাবলী", "রচনাবলি", "অখণ্ড", "সংকলন", "অমনিবাস", "Omnibus")
SERIES_WORDS = _words("সিরিজ", "Series", "series")
MARKETING = _words("রকমারি কালেকশন", "পুরস্কারপ্রাপ্ত লেখকদের বই", "সিডি সহ", "CD সহ", "ফ্রি", "অফার")
VOLUME_BEFORE = "Vol\\.?|Volume|Part"
VOLUME_ORDINALS = "ম|য়|র্থ|ষ্ঠ|তম|st|nd|rd|th"
VOLUME_AFTER = "খণ্ড|খন্ড|পর্ব|ভাগ|Volume|Vol\\.?|Part"

# ---------- fixed values: summaries ----------
FLAP_WORDS = _words("ফ্ল্যাপ", "ফ্যাপ", "ফ্লাপ")
QUOTES = "\"'“”‘’"
BOOK_WORDS = "বইটির|বইটিতে|বইয়ের|বই\\s*এর|বইএর|বইটি|গ্রন্থটির|গ্রন্থের"
#: (class, whether a book word stands before, the label's words), in the order in which they are tried.
SUMMARY_LABELS = (
    ("flap", "optional", "(?:লেখা\\s*)?(?:প্রথম|দ্বিতীয়|শেষের|শেষ)?\\s*(?:" + "|".join(FLAP_WORDS) + ")(?:-?এর|ে|ের)?(?:\\s*(?:লেখা|লিখা|থেকে))?(?:\\s*(?:নেওয়া|নেয়া))?(?:\\s*কিছু)?(?:\\s*কথা)?(?:[^\\n:ঃ]{0,20}[:ঃ])?"),
    ("toc", "optional", "(?:সূচিপত্র|সূচীপত্র|সূচি|সূচী)(?:র|ের)?(?:\\s*কিছু\\s*অংশ)?|বইটিতে\\s*যা\\s*যা\\s*(?:রয়েছে|আছে)"),
    ("blurb", "required", "সম্পর্কে\\s*(?:কিছু\\s*)?কথা"),
    ("excerpt", "required", "(?:কিছু\\s*|একটি\\s*)?(?:অংশবিশেষ|অংশ)"),
    ("summary", "optional", "সংক্ষিপ্ত\\s*বিবরণী?|সারসংক্ষেপ|সারাংশ"),
    ("preface", "optional", "ভূমিকা|মুখবন্ধ|প্রসঙ্গকথা|প্রাককথন|লেখকের\\s*কথা|শুরুর\\s*কথা"),
    ("author_bio", "none", "লেখক\\s*পরিচিতি|লেখকের\\s*পরিচয়"),
)
TAIL_LABELS = "সূচিপত্র|সূচীপত্র|সূচি\\s*[:ঃ]|লেখক\\s*পরিচিতি"
QUOTED_BOOK_WORDS = "গ্রন্থটি|গ্রন্থ|উপন্যাসটি|উপন্যাস|গল্পগ্রন্থ|কাব্যগ্রন্থ|সিরিজ"
CUT_CLASSES = ("flap", "blurb", "excerpt", "summary")
USABLE_FROM = {"flap": 200, "blurb": 200, "summary": 200, "excerpt": 500}

# ---------- fixed values: names ----------
HONORIFICS = _words("রহ.", "রহঃ", "রহ", "রহ:", "র.", "র", "রঃ", "রা.", "রাঃ", "রা", "সা.", "সাঃ", "আ.", "আঃ", "রহিমাহুল্লাহ", "রাহিমাহুল্লাহ", "হাফিজাহুল্লাহ", "হাফিযাহুল্লাহ", "দা.বা.", "দাঃবাঃ")
RANK_TITLES = _words("অব.", "অব:", "অবঃ", "অব", "বীর উত্তম", "বীর বিক্রম", "বীর প্রতীক", "বীরপ্রতীক", "বীরউত্তম")
DESCRIPTORS = _words("টেক্সট", "বিসিএস", "ডিএমসি", "সাংবাদিক", "এম.এ", "অ্যাডভোকেট", "চিত্রশিল্পী", "কার্টুনিস্ট", "ভারত", "আইসিটি", "অনুবাদক", "এল এল বি", "প্রফেসর", "ঢাবি", "ব্যাংকার", "বিএসসি", "অধ্যাপক", "কবি", "লেখক", "সম্পাদক", "শিক্ষক", "ডাক্তার", "ইঞ্জিনিয়ার", "বাংলাদেশ")
LEADING_TITLES = _words(
    "মাওলানা", "মাওলানা", "ড.", "ডঃ", "ড", "ডা.", "ডাঃ", "ডা", "ডক্টর", "প্রফেসর", "অধ্যাপক", "মুফতী", "মুফতি", "শাইখ", "শায়খ", "শেখ.", "আল্লামা", "হাফেজ", "হাফিজ", "হযরত", "হজরত", "প্রকৌশলী",
    "ইঞ্জিনিয়ার", "অ্যাডভোকেট", "এডভোকেট", "ব্যারিস্টার", "লে.", "লেঃ", "কর্নেল", "মেজর", "ব্রিগেডিয়ার", "জেনারেল", "ক্যাপ্টেন", "Dr.", "Prof.", "Professor",
)
TRAILING_TITLES = _words("বীর উত্তম", "বীর বিক্রম", "বীর প্রতীক")
MOHAMMAD = nfc("মোহাম্মদ")
MOHAMMAD_FORMS = _words("মোঃ", "মো.", "মো:", "মোহাম্মদ", "মুহাম্মদ", "মুহাম্মাদ", "মোহাম্মাদ")
ORG_ENDINGS = _words(
    "সম্পাদনা পরিষদ", "সম্পাদনা পর্ষদ", "পরিষদ", "পর্ষদ", "প্রকাশনী", "প্রকাশন", "কুতুবখানা", "লাইব্রেরি", "লাইব্রেরী", "বোর্ড", "টিম", "ফাউন্ডেশন", "একাডেমি", "একাডেমী", "ইনস্টিটিউট", "বিভাগ",
    "Editorial Board", "Team", "Publications", "Publishers", "Foundation", "Limited", "Ltd",
)
ARABIC = "[؀-ۿݐ-ݿﭐ-﷿ﹰ-﻿]+"

# ---------- fixed values: categories ----------
ACADEMIC = ("HSC", "SSC", "JSC", "PSC", "Honors", "Honours", "Degree", "Masters", "Department", "Admission", "Text ?Books?", "Pattho", "Sohayika", "University", "Madrasa", "BCS", "Recruitment", "Job", "Exam", "Exams", "Class", "Board", "Guide", "Suggestion", "Model Test", "Medical", "Medicine", "Engineering", "Nursing", "Teacher registration")
FICTION = ("Novels?", "Stor(?:y|ies)", "Fiction", "Thriller", "Mystery", "Detective", "Horror", "Supernatural", "Adventure", "Fantasy", "Romance", "Romantic", "Humou?r", "Jokes", "Comics?", "Graphic", "Fairy tales?", "Poems?", "Poetry", "Rhymes?", "Ballad", "Drama", "Myth", "Mythological", "legendary", "Fables?", "Intelligence and Secret Agency", "Secret Agency", "Para Psychological", "Literature: Stories", "Literature: Novels", "Literature: Poetry")
NOT_FICTION = ("Non-Fiction", "Non Fiction", "Drama Criticism", "Poem Criticism", "Criticism", "Folk Music", "Music", "Films", "Magazine")
NONFICTION = ("History", "Historical Research", "Islamic", "Religious", "Quran", "Hadith", "Sunnah", "Sirat\\w*", "Seerat", "Self-Help", "Motivational", "Business", "Economics", "Science", "Technology", "Mathematics", "Computer", "Politics", "Political History", "Law", "Health", "Fitness", "Travel", "Articles?", "Philosophy", "Biograph\\w*", "Memories", "Interviews", "Dictionary", "Language", "Reference", "Psychology", "Agricultur\\w*", "Cooking", "Recipe", "Parenting", "Archaeolog\\w*", "Civilization", "Culture", "Society", "Journal", "Research")
PROMO = ("Boimela", "Book ?Fair", "Granthamela", "July Triumph", "In Stock", "Offer", "Combo", "Package", "Pre-?order", "Best ?Sellers?", "New Arrival", "Collections? & Box Sets", "Box Sets?")
GENERIC = ("book", "fiction", "translated books", "foreign language books", "west bengal books", "west bengal books: collection", "bangladesh", "children & teens")
FORMATS = (
    ("comics", ("Comics?", "Graphic")),
    ("poetry", ("Poems?", "Poetry", "Rhymes?", "Ballad")),
    ("drama", ("Drama",)),
    ("novel", ("Novels?",)),
    ("short_story_collection", ("Stor(?:y|ies)", "Fairy tales?", "Fables?")),
)
GENRES = (
    ("detective", ("Detective", "Mystery")),
    ("spy", ("Intelligence and Secret Agency", "Secret Agency")),
    ("thriller", ("Thriller",)),
    ("horror", ("Horror",)),
    ("supernatural", ("Supernatural", "Para Psychological")),
    ("sci_fi", ("Science Fiction",)),
    ("fantasy", ("Fantasy", "Fairy tales?")),
    ("adventure", ("Adventure", "Travel Novel")),
    ("romance", ("Romance", "Romantic")),
    ("humor_satire", ("Humou?r", "Jokes")),
    ("liberation_war", ("Liberation war", "'71", "1971")),
    ("historical", ("Historical", "Biographical novel", "Mughal")),
    ("mythology", ("Myth", "Mythological", "legendary")),
    ("psychological", ("Para Psychological", "Psychological")),
    ("social", ("Political Novel", "Political Story", "Political and Liberation war")),
)
AUDIENCES = (("children", "When\\s*(?:4-8|8-12)|Children(?:\\s*(?:and|&)\\s*Teens)?|Children’s"), ("teen", "When\\s*12-17"))
FORMAT_ORDER = ("comics", "poetry", "drama", "novel", "short_story_collection")
AUDIENCE_ORDER = ("children", "teen")
#: Tag vocabularies that results may use.
FORMAT_TAGS = ("novel", "novella", "short_story_collection", "poetry", "drama", "nonfiction", "memoir", "comics")
GENRE_TAGS = ("detective", "thriller", "spy", "crime", "horror", "supernatural", "sci_fi", "fantasy", "adventure", "romance", "family_drama", "social", "historical", "liberation_war", "humor_satire", "psychological", "mythology")
ORIGIN_TAGS = ("bangladesh", "west_bengal", "translated", "english_language")
ACTION_TAGS = ("map", "exclude", "ignore", "unknown")

# ---------- fixed values: works ----------
SUMMARY_RANK = {"flap": 0, "blurb": 1, "summary": 2, "excerpt": 3}
CONFIDENCE_RANK = {"high": 0, "medium": 1, "low": 2}
PLACEHOLDER_TITLES = _words("book", "books", "বই", "untitled", "n/a")
SLUG_GENERIC = tuple("""
    okhondo akhondo akhanda okhando okhanda sonkolon songkolon sankalan songkalan somogro somogra samagra samogra somgro
    somoggro samagara shomogro rochonaboli rachanabali rachanaboli sheresto shreshtho srestho sherstho shrestho golpo galpo
    uponnas uponnyas upanyas upanyash uponyas kobita kabita collection complete edition hardcover paperback new boi book books
    the a an of and o er bangla version translated onubad anubad part khondo khanda khando khondu khon vol volume voliume
    set box st nd rd th akotre ekotre ebong
""".split())  # fmt: skip
SLUG_PART_WORDS = ("part", "khondo", "khando", "khanda", "khondu", "khon", "kondo", "volume", "voliume", "vol", "porbo", "pormo")
SLUG_PART_FIRST = ("part", "volume", "voliume", "vol", "khondo")
BANGLADESH_COUNTRIES = ("Bangladesh", "East Pakistan", "Pakistan")
INDIA_COUNTRIES = ("India", "Dominion of India")
