"""Names, codes and patterns that results must agree on. They are data, listed in their natural order."""

#: Issuers that reports are searched for, in order of precedence.
TARGETS = [
    "Airbnb",
    "Alon Blue Square",
    "Alstom",
    "Altice International",
    "Ashtrom Group",
    "Axel Springer",
    "Bank Hapoalim",
    "Bank Leumi",
    "Bezeq Group",
    "Booking Holdings",
    "Bright Dairy & Food",
    "Construcciones y Auxiliar de Ferrocarriles (CAF)",
    "Carlsberg",
    "Carrefour",
    "Caterpillar",
    "Cellcom Israel",
    "Cemex",
    "Cisco Systems",
    "CNH Industrial",
    "Danya Cebus",
    "Delek Group",
    "Delta Galil Industries",
    "eDreams ODIGEO",
    "Elbit Systems",
    "Electra Group",
    "Expedia Group",
    "Hamat Group",
    "Heidelberg Materials",
    "Hewlett Packard Enterprise",
    "HikVision",
    "Hilan",
    "Hyundai Heavy Industries",
    "IBM",
    "Israel Chemicals (ICL Group)",
    "Israel Discount Bank",
    "MAN Group",
    "Matrix IT",
    "Mivne Group",
    "Mizrahi Tefahot Bank",
    "Motorola Solutions",
    "Orbia",
    "Partner Communications",
    "Paz Oil Company",
    "Rami Levy Chain Stores Hashikma Marketing 2006",
    "RE/MAX Holdings",
    "Shapir Engineering and Industry",
    "Shikun & Binui",
    "Shufersal",
    "Siemens",
    "Syensqo",
    "Coca-Cola Co",
    "TKH Group",
    "Tripadvisor",
    "TUI Group",
    "Villar International",
    "Vinci / SEMI",
    "Volvo Group",
    "WSP Global",
]

#: Report formats and the patterns of the addresses that they come from; of several that match, the last counts.
FORMAT_URLS = [
    ("EURIZON", "https://www.eurizonam.hr/"),
    ("ANIMA", "https://www.animasgr.it/"),
    ("AMUNDI", "https://www.amundi.com/"),
    ("ASTERIA", "https://www.asteria-im.com/"),
    ("ASTERIA_2023", "https://www.fundsquare.net/.*aKxRJLzQbOPf89pUHU0Jbso"),
    ("EURIZON_OLD", "https://www.fundsquare.net/"),
    ("EURIZON_IT", "https://www.eurizoncapital.com/"),
    ("AMUNDI2", "https://www.amundi.it/"),
    ("FIDEURAM", "https://www.fideuramassetmanagement.ie/"),
    ("MEDIOLANUM", "https://www.mediolanumgestionefondi.it/"),
    ("ARCA", "https://docs.arcafondi.it/"),
]

#: Currency codes and signs. A code whose sign an earlier code has is reported under that earlier code.
CURRENCIES = [
    ("USD", "$"),
    ("EUR", "€"),
    ("GBP", "£"),
    ("JPY", "¥"),
    ("CNY", "¥"),
    ("AUD", "$"),
    ("CAD", "$"),
    ("CHF", "CHF"),
    ("SEK", "kr"),
    ("NOK", "kr"),
    ("DKK", "kr"),
    ("SGD", "$"),
    ("HKD", "$"),
    ("KRW", "₩"),
    ("INR", "₹"),
    ("BRL", "R$"),
    ("MXN", "$"),
    ("RUB", "₽"),
    ("ZAR", "R"),
    ("TRY", "₺"),
    ("PLN", "zł"),
    ("THB", "฿"),
    ("IDR", "Rp"),
    ("MYR", "RM"),
    ("PHP", "₱"),
    ("ILS", "₪"),
    ("AED", "د.إ"),
    ("SAR", "﷼"),
    ("QAR", "ر.ق"),
    ("KWD", "د.ك"),
    ("CLP", "$"),
    ("COP", "$"),
    ("PEN", "S/."),
    ("ARS", "$"),
    ("VND", "₫"),
    ("UAH", "₴"),
    ("CZK", "Kč"),
    ("HUF", "Ft"),
    ("RON", "lei"),
    ("HRK", "kn"),
    ("BGN", "лв"),
    ("ISK", "kr"),
    ("NZD", "$"),
]

#: Words that mean yes and no in settings.
TRUE_WORDS = ["true", "yes", "on", "t", "y", "1"]
FALSE_WORDS = ["false", "no", "off", "f", "n", "0"]

#: Columns of the holdings table, in order.
HOLDINGS_COLUMNS = [
    ("Page report", "int"),
    ("Company", "string"),
    ("Financial instrument", "string"),
    ("Sub-fund", "string"),
    ("Nominal/Quantity", "bigint"),
    ("Market value", "double"),
    ("Currency", "string"),
    ("% Net Assets", "double"),
    ("Acquisition cost", "double"),
    ("Maturity", "date"),
    ("Interest rate", "double"),
]
