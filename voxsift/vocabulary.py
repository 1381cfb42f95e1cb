"""Own word lists: text templates for synthetic data and the rule lexicon.

The synthetic product is a bicycle rental. Slots are written ``{slot}`` and
filled by plain replacement. A template whose slot has no value keeps the slot
as it is.
"""

APP_NAMES = ["Pedalport", "Pedalport Cargo"]
PLATFORMS = ["App Store", "Google Play"]
VERSIONS = ["24.1", "24.3", "24.7", "25.0", "25.2"]
DEVICES = ["Xperia 5", "Fairphone 4", "Redmi Note 12", "iPhone SE", "OnePlus 11", "Zenfone 10"]
OS_VERSIONS = ["Android 13", "Android 14.1", "iOS 17.2", "iOS 17.6.1", "Android 10", "iOS 18"]
ACTIONS = [
    "unlock a bike", "end my ride", "reserve a helmet", "scan the handlebar", "top up my balance",
    "report a flat tyre", "see the next dock", "invite a friend", "print a receipt",
]
STATIONS = ["Harbour Gate", "Old Mill", "North Bridge", "University", "Canal Street", "Fairground", "Town Hall"]
PARTS = ["ride map", "wallet page", "trip history", "dock list"]
FEATURES = [
    "a child seat filter", "group rides", "rain alerts", "a day pass", "voice directions", "hill-free routes",
    "a lost and found desk", "monthly mileage totals", "parking photos", "a watch companion", "gift vouchers",
]
SPAM_LINKS = ["prize.example/claim", "loans.example/fast"]
MAX_RIDES = 40
FIRST_NAMES = ["Amara", "Bruno", "Cleo", "Dmitri", "Elif", "Farid", "Gwen", "Hana", "Ivo", "Jolanta", "Kofi", "Leena"]
LAST_NAMES = ["Abara", "Brandt", "Castell", "Dahl", "Eriksen", "Fontaine", "Gruber", "Horvat", "Ibsen", "Jansky"]
MAIL_DOMAINS = ["rider.example", "mailbox.example", "posthorn.example"]

# text template per category; for feature requests the matching suggested subject below
REVIEW_TEMPLATES = {
    "Bug": [
        "Stood at {station} for ten minutes. The app hangs when I {action} and the lock stays shut.",
        "{version} on my {device}: the {part} is blank, nothing gets drawn at all.",
        "I was charged twice because the timer kept running after I gave the bike back at {station}.",
        "Bluetooth pairing fails on {os} as soon as I {action}.",
        "My whole trip history disappeared overnight.",
        "It shuts itself down each time I {action}. {device}, {os}.",
        "The QR reader does not work in {version}; the torch button is dead as well.",
        "Stuck on the loading wheel at {station}, the ride never ended by itself.",
        "Wrong dock count at {station} again: the {part} says nine, there are none.",
    ],
    "Feature Request": [
        "You could offer {feature}, then our whole family would ride.",
        "Have you thought about people with reading glasses? Bigger buttons, perhaps.",
        "One thing is missing: {feature}. Put it on your list!",
        "My wish: {feature}. Even a simple version would do.",
    ],
    "Praise": [
        "Smoothest rental I ever had, two taps and off you go.",
        "Lovely bikes, friendly crew at {station}, a joy every morning.",
        "Thumbs up for {version}, the {part} is a delight.",
        "My commute through {station} is now the nicest part of the day.",
        "Flawless for a year. Kudos to the mechanics!",
    ],
    "Complaint": [
        "Prices went up twice this spring and the bikes got older.",
        "The helpline kept me waiting for an hour and then hung up.",
        "Saddles are filthy at {station}, nobody cleans them.",
        "A deposit of fifty is a rip-off for a rusty bike.",
        "Never a free bike near {station} before nine. Disappointing.",
        "The {part} is a maze, my parents gave up on it.",
        "Drains my phone to zero by noon, poor value.",
    ],
    "Spam": [
        "Congratulations rider, your voucher waits at {url}",
        "Instant loans without papers, write to {url}",
        "asdf asdf jkl jkl",
        "I sell used couches, message me on my page, cheap delivery",
    ],
}
REVIEW_SUBJECTS = {
    "Feature Request": ["Proposal from a rider", "Accessibility", "Missing in the app", "Wish list"],
}
EMAIL_SUBJECTS = {
    "Bug": ["Lock did not open", "Charged twice", "Ride cannot be ended", "Blank page", "Bluetooth trouble"],
    "Feature Request": ["Proposal", "Something for your wish list", "From a daily rider", "Could you offer this?"],
}
EMAIL_BODIES = {
    "Bug": [
        "Customer number on file.\nPlace: {station}\nPhone: {device}, {os}, app {version}\n"
        "Steps to reproduce:\n- walk up to a bike\n- open the {part}\n- {action}\n\nThe lock stays shut. {name}",
        "{name} here. Yesterday at {station} the app hangs when I {action}; I had to walk home.",
        "I was charged twice for one ride from {station}. My bank says both are final.\n\n{name}\n({os}, {version})",
        "Since {version} the {part} is blank on my {device}. Restarting does not work either.\n\nRegards from {station}, {name}",
    ],
    "Feature Request": [
        "I ride {rides} times a month, mostly from {station}. You could offer {feature}.\n\n{name}",
        "My wish: {feature}. I asked around at {station}, others agree. {name}",
        "Have you thought about night riders? {name}, {rides} rides so far",
    ],
}

# --- rule lexicon: phrases looked up in lower-cased text ----------------------
LEXICON = {
    "Bug": [
        "hangs", "stays shut", "blank", "charged twice", "pairing fails", "disappeared", "shuts itself down",
        "not work", "is dead", "stuck on", "never ended", "wrong dock count", "nothing gets drawn", "kept running",
    ],
    "Feature Request": [
        "you could offer", "have you thought", "is missing:", "put it on your list", "my wish", "even a simple version",
        "perhaps", "others agree", "times a month",
    ],
    "Praise": [
        "smoothest", "lovely", "a joy", "thumbs up", "delight", "nicest", "flawless", "kudos", "two taps", "friendly",
    ],
    "Complaint": [
        "prices", "got older", "waiting", "hung up", "filthy", "nobody cleans", "rip-off", "rusty", "disappointing",
        "never a free", "maze", "gave up", "drains", "poor value",
    ],
    "Spam": [
        "congratulations", "voucher waits", "instant loans", "without papers", "asdf", "jkl", "i sell", "on my page",
        "cheap delivery",
    ],
}
# "no hang" is no defect; the phrase is blanked before the lookup
NEGATED_PHRASES = r"(^|[^a-z])(no|without) (hang|blank|fault|error)[a-z]*"

# --- bug details ---------------------------------------------------------------
OS_PATTERN = r"(Android|iOS) ([0-9]+(\.[0-9]+)*)"
DEVICE_PATTERN = r"(Xperia [0-9]+|Fairphone [0-9]+|Redmi Note [0-9]+|iPhone SE|OnePlus [0-9]+|Zenfone [0-9]+)"
STEPS_BLOCK_PATTERN = r"(?is)steps to reproduce:\s*(.*?)(\n\s*\n|\z)"
TRIGGER_PATTERN = r"(?i)(each time|as soon as|when) i ([^.,;\n]+)"
SEVERITY_PHRASES = [
    ("Critical", ["charged twice", "disappeared", "kept running"]),
    ("High", ["stays shut", "shuts itself down", "never ended", "unlock"]),
    ("Low", ["torch", "dock count"]),
]
SEVERITY_OTHERWISE = "Medium"

# --- feature details -----------------------------------------------------------
FEATURE_PATTERN = r"(?i)(you could offer|is missing:|my wish:) (an? )?([a-z][a-z -]*)"
FEATURE_OTHERWISE = "something not named"
