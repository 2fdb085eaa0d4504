"""Fixed values.

Every literal below must equal the behaviour being reproduced for results to
match byte for byte: prompt wording, fallback texts, thresholds, word lists,
patterns and symbol lists.  They are stated once, in natural order, and used
by the column functions in ``labels`` and ``text``.
"""

# ---------------------------------------------------------------- fixed values
# Return classes: up when the return is >= 0, magnitude = ceil(|100 * r|),
# magnitudes above this cap print as "5+".
BIN_CAP = 5

# Class -> phrase, first form (correct mapping).
BIN_PHRASE_V1 = {
    "U0": "up by 0", "U1": "up by 0-1%", "U2": "up by 1-2%", "U3": "up by 2-3%",
    "U4": "up by 3-4%", "U5": "up by 4-5%", "U5+": "up by more than 5%",
    "D0": "down by 0", "D1": "down by 0-1%", "D2": "down by 1-2%", "D3": "down by 2-3%",
    "D4": "down by 3-4%", "D5": "down by 4-5%", "D5+": "down by more than 5%",
}
# Class -> phrase, second form: these replacements applied in this order to
# the class text, each one over the whole result of the previous one.
BIN_PHRASE_V2_STEPS = [
    ("U", "Up by "), ("D", "Down by "), ("5+", "more than 5%"), ("5", "4-5%"),
    ("4", "3-4%"), ("3", "2-3%"), ("2", "1-2%"), ("1", "0-1%"),
]

# Week header, later form and earlier form.
HEADER_LATER = "From {start} to {end}, {symbol}'s stock price {move} from {sp} to {ep}."
HEADER_EARLIER = ("From {start} to {end}, {symbol}'s stock price {move} from {sp} to {ep}. "
                  "News during this period are listed below:\n\n")
MOVE_UP, MOVE_DOWN = "increased", "decreased"

# Article text: later form "- headline: summary", earlier form below.
ARTICLE_EARLIER = "[Headline]: {headline}\n[Summary]: {summary}\n"
NO_NEWS_LATER = "No relevant news reported."
NO_NEWS_ONLINE = "No relative news reported."
NEWS_TOP_K = 5
# Boilerplate articles are dropped by summary prefix (earlier long prefix,
# later short prefix).
BOILERPLATE_LONG = "Looking for stock market analysis and research with proves results?"
BOILERPLATE_SHORT = "Looking for stock market analysis"
# How a missing headline or summary prints inside a text.
NULL_TEXT = "None"

# Basics listing (earlier form).
BASICS_LIST_HEAD = ("Some recent basic financials of {symbol}, reported at {period}, "
                    "are presented below:\n\n[Basic Financials]:\n\n")
BASICS_LIST_EMPTY = "[Basic Financials]:\n\nNo basic financial reported."

# Basics highlights, first variant: (metric, threshold, template).  A missing
# metric counts as -1; a present NULL stops the list.
HIGHLIGHTS_UTILS = [
    ("peTTM", 0.0, "High valuation (P/E: {})"),
    ("roeTTM", 0.3, "Strong return on equity (ROE: {})"),
    ("operatingMargin", 0.2, "Healthy operating margin ({})"),
    ("totalDebtToEquity", 2.0, "High leverage (Debt/Equity: {})"),
    ("netMargin", 0.2, "Solid profitability (Net Margin: {})"),
    ("roaTTM", 0.1, "Efficient asset utilization (ROA: {})"),
]
HIGHLIGHTS_EMPTY = "[Basic Financials]:\n\nNo basic financials reported."
HIGHLIGHTS_NONE = "[Basic Financials Summary]:\n\nNo strong indicators reported."
HIGHLIGHTS_HEAD = "[Basic Financials Summary]:\n\n"
HIGHLIGHTS_UNAVAILABLE = "Financial summary unavailable."
# Second variant: P/E listed whenever present (threshold None), margin 0.3.
HIGHLIGHTS_DATA = [
    ("peTTM", None, "High valuation (P/E: {})"),
    ("roeTTM", 0.3, "Strong return on equity (ROE: {})"),
    ("operatingMargin", 0.3, "Healthy operating margin ({})"),
    ("totalDebtToEquity", 2.0, "High leverage (Debt/Equity: {})"),
    ("netMargin", 0.2, "Solid profitability (Net Margin: {})"),
    ("roaTTM", 0.1, "Efficient asset utilization (ROA: {})"),
]

# Company introduction, later form (offline prompts) and earlier form (online).
COMPANY_INTRO_LATER = (
    "[Company Introduction]:\n\n{name} is a leading entity in the {finnhubIndustry} sector. "
    "Incorporated and publicly traded since {ipo}, it currently has a market cap of "
    "{marketCapitalization} {currency} with {shareOutstanding} shares outstanding. "
    "It operates primarily in {country}, trading as {ticker} on the {exchange}.")
COMPANY_INTRO_EARLIER = (
    "[Company Introduction]:\n\n{name} is a leading entity in the {finnhubIndustry} sector. "
    "Incorporated and publicly traded since {ipo}, the company has established its reputation "
    "as one of the key players in the market. As of today, {name} has a market capitalization "
    "of {marketCapitalization} in {currency}, with {shareOutstanding} shares outstanding."
    "\n\n{name} operates primarily in the {country}, trading under the ticker {ticker} on the "
    "{exchange}. As a dominant force in the {finnhubIndustry} space, the company continues to "
    "innovate and drive progress within the industry.")
CRYPTO_INTRO = ("[Cryptocurrency Introduction]: {description}. "
                "It has a market capilization of {marketCap}.")

# Task ending of offline prompts.
TASK_ENDING = (
    "\n\nBased on all the information before {start_date}, complete the following three steps:\n\n"
    "1. List 2-4 positive developments inferred from company-related news or financials.\n"
    "2. List 2-4 potential concerns that might negatively affect the company's performance.\n"
    "3. Make a prediction for {symbol}'s stock movement from {start_date} to {end_date}.\n\n"
    "Your answer must strictly follow this format:\n\n"
    "[Positive Developments]:\n1. ...\n2. ...\n\n"
    "[Potential Concerns]:\n1. ...\n2. ...\n\n"
    "[Prediction & Analysis]:\n"
    "Prediction: [Up or Down] by [0-1%, 1-2%, 2-3%, 3-4%, 4-5%, more than 5%]\n"
    "Analysis: Base your prediction on the listed developments and concerns only, "
    "not price movements.")

# Task ending of online (as-of-day) prompts.
ONLINE_ENDING = (
    "\n\nBased on all the information before {curday}, let's first analyze the positive "
    "developments and potential concerns for {symbol}. Come up with 2-4 most important factors "
    "respectively and keep them concise. Most factors should be inferred from company related "
    "news. Then make your prediction of the {symbol} stock price movement for next week "
    "({period}). Provide a summary analysis to support your prediction.")

# System prompts by asset class.
SYSTEM_PROMPTS = {
    "company": (
        "You are a seasoned stock market analyst. Your task is to list the positive developments "
        "and potential concerns for companies based on relevant news and basic financials from "
        "the past weeks, then provide an analysis and prediction for the companies' stock price "
        "movement for the upcoming week. Your answer format should be as follows:\n\n"
        "[Positive Developments]:\n1. ...\n\n[Potential Concerns]:\n1. ...\n\n"
        "[Prediction & Analysis]:\n...\n"),
    "crypto": (
        "You are a seasoned crypto market analyst. Your task is to list the positive developments "
        "and potential concerns for cryptocurrencies based on relevant news and basic financials "
        "from the past weeks, then provide an analysis and prediction for the cryptocurrencies "
        "price movement for the upcoming week. Your answer format should be as follows:\n\n"
        "[Positive Developments]:\n1. ...\n\n[Potential Concerns]:\n1. ...\n\n"
        "[Prediction & Analysis]:\n...\n"),
}
# Training form: system prompt rewrite and instruction wrapper.
SYSTEM_REWRITE_FROM = ":\n..."
SYSTEM_REWRITE_TO = "\nPrediction: ...\nAnalysis: ..."
B_INST, E_INST = "[INST]", "[/INST]"
B_SYS, E_SYS = "<<SYS>>\n", "\n<</SYS>>\n\n"

# Old-form request sentence (used to read period and label back from a prompt).
ASSUME_PATTERN = (r"Then let's assume your prediction for next week \((.*)\) is "
                  r"((:?up|down) by .*%).")
ASSUME_FULL_PATTERN = (
    r"Then let's assume your prediction for next week \((.*)\) is (up|down) by ((:?.*)%). "
    r"Provide a summary analysis to support your prediction. The prediction result need to be "
    r"inferred from your analysis at the end, and thus not appearing as a foundational factor "
    r"of your analysis.")
ASSUME_SENTENCE = (
    "Then let's assume your prediction for next week ({period}) is {phrase}. Provide a summary "
    "analysis to support your prediction. The prediction result need to be inferred from your "
    "analysis at the end, and thus not appearing as a foundational factor of your analysis.")
REQUEST_SENTENCE = ("Then make your prediction of the {symbol} cryptocurrency price movement for "
                    "next week ({period}). Provide a summary analysis to support your prediction.")
ANALYSIS_HEADING_PATTERN = r"\[Prediction & Analysis\]:\s*"
ANALYSIS_HEADING_REPLACEMENT = "[Prediction & Analysis]:\nPrediction: {label}\nAnalysis: "

# Fuzzy prediction parsing: up words are tested first, then down words.
UP_WORDS = ["increase", "gain", "rise", "appreciate"]
DOWN_WORDS = ["decrease", "drop", "decline", "fall", "down"]
RANGE_PERCENT = r"(\d+(\.\d+)?)-(\d+(\.\d+)?)%"
SINGLE_PERCENT = r"(\d+(\.\d+)?)%"
DEFAULT_MAGNITUDE = "1"

# Defaults of a whole run.
MAX_NEW_TOKENS = 512
DEFAULT_MIN_WEEKS = 1
DEFAULT_MAX_WEEKS = 4
DEFAULT_TRAIN_RATIO = 0.6
DEFAULT_ONLINE_WEEKS = 3

# Symbol universes (the second list names AD.AS twice; the universe is a set).
DOW_30 = [
    "AXP", "AMGN", "AAPL", "BA", "CAT", "CSCO", "CVX", "GS", "HD", "HON",
    "IBM", "INTC", "JNJ", "KO", "JPM", "MCD", "MMM", "MRK", "MSFT", "NKE",
    "PG", "TRV", "UNH", "CRM", "VZ", "V", "WBA", "WMT", "DIS", "DOW",
]
EURO_STOXX_50 = [
    "ADS.DE", "ADYEN.AS", "AD.AS", "AI.PA", "AIR.PA", "ALV.DE",
    "ABI.BR", "ASML.AS", "CS.PA", "BAS.DE", "BAYN.DE", "BBVA.MC",
    "SAN.MC", "BMW.DE", "BNP.PA", "BN.PA", "DAI.DE", "DPW.DE", "DTE.DE",
    "ENEL.MI", "ENGI.PA", "EL.PA", "FRE.DE", "IBE.MC", "ITX.MC", "IFX.DE",
    "INGA.AS", "ISP.MI", "KER.PA", "AD.AS", "PHIA.AS", "OR.PA", "LIN.DE",
    "MC.PA", "MUV2.DE", "NOKIA.SE", "ORA.PA", "RI.PA", "SAF.PA", "SAN.PA",
    "SAP.DE", "SU.PA", "SIE.DE", "GLE.PA", "STM.PA", "TEF.MC", "TTE.PA",
    "UNA.AS", "DG.PA", "VOW3.DE",
]
CRYPTO = [
    "BTC-USD", "ETH-USD", "ADA-USD", "XRP-USD", "SOL-USD",
    "DOT-USD", "AVAX-USD", "DOGE-USD", "TRX-USD",
]
# Index names accepted by a run and the folder label each one gets.
INDEX_LABELS = {"dow": "DOW-30", "euro": "EURO-STOXX-50", "crypto": "CRYPTO"}
# ------------------------------------------------------------ end fixed values
