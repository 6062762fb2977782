"""Court cases: subject and class codes of the unified procedural tables.

Fixed values: codes, reading priorities and the courts of each state.
"""

FEMICIDE = [12091]
TYPIFIED = [14943, 14942, 14944, 14684]
PROTECTIVE_BREACH = [14227, 14229]
DOMESTIC_CONTEXT = [10949, 10948, 12194, 12196, 5560]
NOT_WOMAN = [12195]
ATTEMPT = [5555]
DEATH_SIGN = [3458]
PROTECTIVE_CLASSES = [1268, 12423]

# Reading order: form, offence, gender qualifier, context.
PRIORITY = {
    5555: 10,
    3372: 20, 3370: 21, 3371: 22, 3458: 23,
    12091: 30, 14943: 31, 14942: 32, 14944: 32, 14684: 33, 14227: 34, 14229: 34,
    10949: 40, 10948: 40, 12194: 41, 12196: 41, 5560: 42,
}
LAST_PRIORITY = 99
NAMELESS = "ASSUNTO "

SUBSETS = {
    "feminicidio": FEMICIDE,
    "violencia_genero": FEMICIDE + TYPIFIED + PROTECTIVE_BREACH,
    "contexto_domestico": FEMICIDE + TYPIFIED + PROTECTIVE_BREACH + DOMESTIC_CONTEXT,
}

FIRST_YEAR = 1990
PLAUSIBLE_SUBJECTS = 20

STATES = ["AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
          "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO"]
STATE_OF_COURT = {f"TJ{'DFT' if s == 'DF' else s}": s for s in STATES}

FIELDS = ["id", "tribunal", "numeroProcesso", "dataAjuizamento", "grau", "nivelSigilo", "classe",
          "assuntos", "orgaoJulgador", "formato", "dataHoraUltimaAtualizacao"]
