"""Fixed venue tables: exchange rules, country and currency suffixes, prefix hints.

All values here are fixed: they must equal the published mapping for results to agree.
"""

from __future__ import annotations

# Ticker suffixes the vendor knows ("" means a plain ticker).
VENDOR_SUFFIXES = [
    "HK", "KS", "KQ", "T", "TW", "TWO", "NS", "BO", "SS", "SZ", "SA", "JO", "SR", "PS", "IS", "BK", "JK", "KL", "SI",
    "QA", "KW", "BD", "AD", "DU", "WA", "PR", "SN", "AX", "L", "PA", "DE", "SW", "AT", "AS", "MI", "MC", "HE", "VI",
    "LS", "IR", "BR", "CO", "OL", "NZ", "TA", "ST", "",
]

# Suffixes whose numeric symbols are padded with zeros, and to what width.
PADDED = {"HK": 4, "KS": 6, "KQ": 6, "TW": 4, "TWO": 4, "T": 4, "SS": 6, "SZ": 6, "SR": 4}

# Suffixes by country, used when no exchange rule matches.
COUNTRY_SUFFIXES = {
    "AUSTRALIA": ["AX"],
    "AUSTRIA": ["VI"],
    "BELGIUM": ["BR"],
    "BRAZIL": ["SA"],
    "CHILE": ["SN"],
    "CHINA": ["HK", "SS", "SZ"],
    "CZECH REPUBLIC": ["PR"],
    "DENMARK": ["CO"],
    "FINLAND": ["HE"],
    "FRANCE": ["PA"],
    "GERMANY": ["DE"],
    "GREECE": ["AT"],
    "HONG KONG": ["HK"],
    "HUNGARY": ["BD"],
    "INDIA": ["NS", "BO"],
    "INDONESIA": ["JK"],
    "IRELAND": ["IR"],
    "ISRAEL": ["TA"],
    "ITALY": ["MI"],
    "JAPAN": ["T"],
    "KOREA (SOUTH)": ["KS", "KQ"],
    "KUWAIT": ["KW"],
    "MALAYSIA": ["KL"],
    "MEXICO": ["MX"],
    "NETHERLANDS": ["AS"],
    "NEW ZEALAND": ["NZ"],
    "NORWAY": ["OL"],
    "PHILIPPINES": ["PS"],
    "POLAND": ["WA"],
    "PORTUGAL": ["LS"],
    "QATAR": ["QA"],
    "SAUDI ARABIA": ["SR"],
    "SINGAPORE": ["SI"],
    "SOUTH AFRICA": ["JO"],
    "SPAIN": ["MC"],
    "SWEDEN": ["ST"],
    "SWITZERLAND": ["SW"],
    "TAIWAN": ["TW", "TWO"],
    "THAILAND": ["BK"],
    "TURKEY": ["IS"],
    "UNITED ARAB EMIRATES": ["AD", "DU"],
    "UNITED KINGDOM": ["L"],
}

# Suffixes by currency, the last resort.
CURRENCY_SUFFIXES = {
    "BRL": ["SA"],
    "HKD": ["HK"],
    "KRW": ["KS", "KQ"],
    "TWD": ["TW", "TWO"],
    "JPY": ["T"],
    "INR": ["NS", "BO"],
    "CNY": ["SS", "SZ"],
    "SAR": ["SR"],
    "THB": ["BK"],
    "IDR": ["JK"],
    "MYR": ["KL"],
    "SGD": ["SI"],
    "QAR": ["QA"],
    "KWD": ["KW"],
    "MXN": ["MX"],
    "PHP": ["PS"],
    "HUF": ["BD"],
    "PLN": ["WA"],
    "TRY": ["IS"],
    "ZAR": ["JO"],
}

# Venues on which securities of an ISIN prefix may be listed.
PREFIX_VENUES = {
    "AE": ["ABU_DHABI_SECURITIES_EXCHANGE", "DUBAI_FINANCIAL_MARKET"],
    "AT": ["WIENER_BOERSE"],
    "AU": ["AUSTRALIAN_SECURITIES_EXCHANGE"],
    "BE": ["EURONEXT_BRUSSELS"],
    "BM": ["HONG_KONG_EXCHANGE", "US_NYSE", "US_NASDAQ", "SINGAPORE_EXCHANGE", "EURONEXT_AMSTERDAM"],
    "BR": ["BRAZIL_B3"],
    "CH": ["SIX_SWISS_EXCHANGE"],
    "CL": ["SANTIAGO_STOCK_EXCHANGE"],
    "CN": ["SHANGHAI_STOCK_EXCHANGE", "SHENZHEN_STOCK_EXCHANGE", "HONG_KONG_EXCHANGE"],
    "CZ": ["PRAGUE_STOCK_EXCHANGE"],
    "DE": ["XETRA"],
    "DK": ["OMX_COPENHAGEN"],
    "ES": ["BOLSA_DE_MADRID", "EURONEXT_LISBON"],
    "FI": ["NASDAQ_HELSINKI"],
    "FR": ["EURONEXT_PARIS"],
    "GB": ["LONDON_STOCK_EXCHANGE", "US_NASDAQ", "US_NYSE", "NASDAQ_NORDIC"],
    "GR": ["ATHENS_EXCHANGE"],
    "HK": ["HONG_KONG_EXCHANGE"],
    "HU": ["BUDAPEST_STOCK_EXCHANGE"],
    "ID": ["INDONESIA_STOCK_EXCHANGE"],
    "IE": ["IRISH_STOCK_EXCHANGE"],
    "IL": ["TEL_AVIV_STOCK_EXCHANGE", "US_NASDAQ", "US_NYSE"],
    "IN": ["NSE_INDIA", "BSE_INDIA"],
    "IT": ["BORSA_ITALIANA"],
    "JE": ["LONDON_STOCK_EXCHANGE", "EURONEXT_AMSTERDAM"],
    "JP": ["TOKYO_STOCK_EXCHANGE"],
    "KR": ["KOREA_STOCK_EXCHANGE", "KOREA_KOSDAQ"],
    "KW": ["KUWAIT_STOCK_EXCHANGE"],
    "KY": ["HONG_KONG_EXCHANGE", "US_NASDAQ", "US_NYSE"],
    "LU": ["EURONEXT_PARIS", "BORSA_ITALIANA", "EURONEXT_AMSTERDAM", "JOHANNESBURG_STOCK_EXCHANGE", "US_NYSE"],
    "MX": ["BOLSA_MEXICANA_DE_VALORES"],
    "MY": ["BURSA_MALAYSIA"],
    "NL": ["EURONEXT_AMSTERDAM", "BORSA_ITALIANA", "EURONEXT_PARIS", "US_NASDAQ", "US_NYSE", "BOLSA_DE_MADRID"],
    "NO": ["OSLO_BORS"],
    "NZ": ["NEW_ZEALAND_EXCHANGE", "AUSTRALIAN_SECURITIES_EXCHANGE"],
    "PH": ["PHILIPPINE_STOCK_EXCHANGE"],
    "PL": ["WARSAW_STOCK_EXCHANGE"],
    "PT": ["EURONEXT_LISBON"],
    "QA": ["QATAR_EXCHANGE"],
    "RU": ["STANDARD_CLASSICA_FORTS", "LONDON_STOCK_EXCHANGE"],
    "SA": ["SAUDI_STOCK_EXCHANGE"],
    "SE": ["NASDAQ_NORDIC", "US_NYSE"],
    "SG": ["SINGAPORE_EXCHANGE", "HONG_KONG_EXCHANGE"],
    "TH": ["THAILAND_STOCK_EXCHANGE"],
    "TR": ["ISTANBUL_STOCK_EXCHANGE"],
    "TW": ["TAIWAN_STOCK_EXCHANGE", "TAIWAN_OTC"],
    "US": ["US_NASDAQ", "US_NYSE", "LONDON_STOCK_EXCHANGE", "HONG_KONG_EXCHANGE", "STANDARD_CLASSICA_FORTS"],
    "ZA": ["JOHANNESBURG_STOCK_EXCHANGE"],
}

# Suffix tokens an exchange text may contain for an ISIN prefix.
PREFIX_TOKENS = {
    "AU": ["AX"],
    "BR": ["SA"],
    "CH": ["SW", "VX", "XC"],
    "DE": ["DE", "F", "BE", "DU", "HM", "MU", "SG"],
    "DK": ["CO"],
    "EG": ["CA"],
    "GB": ["L"],
    "HK": ["HK"],
    "ID": ["JK"],
    "IL": ["TA"],
    "IN": ["NS", "BO"],
    "JP": ["T"],
    "MX": ["MX"],
    "NL": ["AS"],
    "PH": ["PS"],
    "SA": ["SR"],
    "SE": ["ST"],
    "TW": ["TW"],
    "US": ["NASDAQ", "NYSE", "AMEX"],
    "ZA": ["JO"],
}

# Exchange rules (kind, exchange name, venue, suffixes, priority). ``NASDAQ`` and ``NYSE``
# have an empty suffix on purpose: their tickers are plain.
EXCHANGE_RULES = [
    ("exact", "ABU DHABI SECURITIES EXCHANGE", "ABU_DHABI_SECURITIES_EXCHANGE", "AD", 10),
    ("exact", "DUBAI FINANCIAL MARKET", "DUBAI_FINANCIAL_MARKET", "DU", 10),
    ("exact", "PHILIPPINE STOCK EXCHANGE INC.", "PHILIPPINE_STOCK_EXCHANGE", "PS", 10),
    ("exact", "BOLSA MEXICANA DE VALORES", "BOLSA_MEXICANA_DE_VALORES", "MX", 10),
    ("exact", "BUDAPEST STOCK EXCHANGE", "BUDAPEST_STOCK_EXCHANGE", "BD", 10),
    ("exact", "ATHENS EXCHANGE S.A. CASH MARKET", "ATHENS_EXCHANGE", "AT", 10),
    ("exact", "HONG KONG EXCHANGES AND CLEARING LTD", "HONG_KONG_EXCHANGE", "HK", 10),
    ("exact", "INDONESIA STOCK EXCHANGE", "INDONESIA_STOCK_EXCHANGE", "JK", 10),
    ("exact", "ISTANBUL STOCK EXCHANGE", "ISTANBUL_STOCK_EXCHANGE", "IS", 10),
    ("exact", "JOHANNESBURG STOCK EXCHANGE", "JOHANNESBURG_STOCK_EXCHANGE", "JO", 10),
    ("exact", "KOREA EXCHANGE (STOCK MARKET)", "KOREA_STOCK_EXCHANGE", "KS", 10),
    ("exact", "KOREA EXCHANGE (KOSDAQ)", "KOREA_KOSDAQ", "KQ", 10),
    ("exact", "KUWAIT STOCK EXCHANGE", "KUWAIT_STOCK_EXCHANGE", "KW", 10),
    ("exact", "NATIONAL STOCK EXCHANGE OF INDIA", "NSE_INDIA", "NS", 10),
    ("exact", "BSE LTD", "BSE_INDIA", "BO", 10),
    ("exact", "PRAGUE STOCK EXCHANGE", "PRAGUE_STOCK_EXCHANGE", "PR", 10),
    ("exact", "QATAR EXCHANGE", "QATAR_EXCHANGE", "QA", 10),
    ("exact", "SANTIAGO STOCK EXCHANGE", "SANTIAGO_STOCK_EXCHANGE", "SN", 10),
    ("exact", "SAUDI STOCK EXCHANGE", "SAUDI_STOCK_EXCHANGE", "SR", 10),
    ("exact", "SHANGHAI STOCK EXCHANGE", "SHANGHAI_STOCK_EXCHANGE", "SS", 10),
    ("exact", "SHENZHEN STOCK EXCHANGE", "SHENZHEN_STOCK_EXCHANGE", "SZ", 10),
    ("exact", "STOCK EXCHANGE OF THAILAND", "THAILAND_STOCK_EXCHANGE", "BK", 10),
    ("exact", "TAIWAN STOCK EXCHANGE", "TAIWAN_STOCK_EXCHANGE", "TW", 10),
    ("exact", "GRETAI SECURITIES MARKET", "TAIWAN_OTC", "TWO", 10),
    ("exact", "WARSAW STOCK EXCHANGE/EQUITIES/MAIN MARKET", "WARSAW_STOCK_EXCHANGE", "WA", 10),
    ("exact", "BURSA MALAYSIA", "BURSA_MALAYSIA", "KL", 10),
    ("exact", "XBSP", "BRAZIL_B3", "SA", 10),
    ("exact", "ASX - ALL MARKETS", "AUSTRALIAN_SECURITIES_EXCHANGE", "AX", 10),
    ("exact", "BOLSA DE MADRID", "BOLSA_DE_MADRID", "MC", 10),
    ("exact", "BORSA ITALIANA", "BORSA_ITALIANA", "MI", 10),
    ("exact", "EURONEXT AMSTERDAM", "EURONEXT_AMSTERDAM", "AS", 10),
    ("exact", "IRISH STOCK EXCHANGE - ALL MARKET", "IRISH_STOCK_EXCHANGE", "IR", 10),
    ("exact", "LONDON STOCK EXCHANGE", "LONDON_STOCK_EXCHANGE", "L", 10),
    ("exact", "NASDAQ OMX HELSINKI LTD.", "NASDAQ_HELSINKI", "HE", 10),
    ("exact", "NASDAQ OMX NORDIC", "NASDAQ_NORDIC", "ST", 10),
    ("exact", "NEW ZEALAND EXCHANGE LTD", "NEW_ZEALAND_EXCHANGE", "NZ", 10),
    ("exact", "NYSE EURONEXT - EURONEXT BRUSSELS", "EURONEXT_BRUSSELS", "BR", 10),
    ("exact", "NYSE EURONEXT - EURONEXT LISBON", "EURONEXT_LISBON", "LS", 10),
    ("exact", "NYSE EURONEXT - EURONEXT PARIS", "EURONEXT_PARIS", "PA", 10),
    ("exact", "OMX NORDIC EXCHANGE COPENHAGEN A/S", "OMX_COPENHAGEN", "CO", 10),
    ("exact", "OSLO BORS ASA", "OSLO_BORS", "OL", 10),
    ("exact", "SIX SWISS EXCHANGE", "SIX_SWISS_EXCHANGE", "SW", 10),
    ("exact", "SINGAPORE EXCHANGE", "SINGAPORE_EXCHANGE", "SI", 10),
    ("exact", "TEL AVIV STOCK EXCHANGE", "TEL_AVIV_STOCK_EXCHANGE", "TA", 10),
    ("exact", "TOKYO STOCK EXCHANGE", "TOKYO_STOCK_EXCHANGE", "T", 10),
    ("exact", "WIENER BOERSE AG", "WIENER_BOERSE", "VI", 10),
    ("exact", "XETRA", "XETRA", "DE", 10),
    ("exact", "NASDAQ", "US_NASDAQ", "", 10),
    ("exact", "NYSE", "US_NYSE", "", 10),
    ("contains", "EURONEXT PARIS", "EURONEXT_PARIS", "PA", 50),
    ("contains", "EURONEXT BRUSSELS", "EURONEXT_BRUSSELS", "BR", 50),
    ("contains", "EURONEXT LISBON", "EURONEXT_LISBON", "LS", 50),
    ("contains", "EURONEXT AMSTERDAM", "EURONEXT_AMSTERDAM", "AS", 50),
    ("contains", "HONG KONG", "HONG_KONG_EXCHANGE", "HK", 50),
    ("contains", "PHILIPPINE STOCK EXCHANGE", "PHILIPPINE_STOCK_EXCHANGE", "PS", 50),
    ("contains", "BUDAPEST", "BUDAPEST_STOCK_EXCHANGE", "BD", 50),
    ("contains", "ABU DHABI", "ABU_DHABI_SECURITIES_EXCHANGE", "AD", 50),
    ("contains", "DUBAI FINANCIAL MARKET", "DUBAI_FINANCIAL_MARKET", "DU", 50),
    ("contains", "BORSA ITALIANA", "BORSA_ITALIANA", "MI", 50),
    ("contains", "TOKYO STOCK EXCHANGE", "TOKYO_STOCK_EXCHANGE", "T", 50),
    ("contains", "LONDON STOCK EXCHANGE", "LONDON_STOCK_EXCHANGE", "L", 50),
    ("contains", "SINGAPORE EXCHANGE", "SINGAPORE_EXCHANGE", "SI", 50),
    ("contains", "XETRA", "XETRA", "DE", 50),
]

# What marks a security the vendor does not serve.
UNSUPPORTED_COUNTRIES = ["RUSSIAN FEDERATION"]
UNSUPPORTED_EXCHANGES = ["STANDARD-CLASSICA-FORTS", "STANDARD CLASSICA-FORTS"]
UNSUPPORTED_ISIN_PREFIXES = ["RU"]

# What marks an Indian security, and countries with a plain and a local listing.
INDIA_COUNTRIES = ["INDIA"]
INDIA_EXCHANGE_WORDS = ["NATIONAL STOCK EXCHANGE OF INDIA", "BSE", "INDIA"]
INDIA_EXCHANGES = ["NSE"]
PLAIN_OR_LOCAL_COUNTRIES = ["ISRAEL", "UNITED KINGDOM", "UK", "GREAT BRITAIN"]
