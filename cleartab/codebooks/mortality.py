"""Death records and the assault group X85-Y09 of ICD-10.

Fixed values: the codes and labels below are published by the source.
Code 9 means "ignored", which is a value of its own and not a null.
"""

SEX = {"1": "MASCULINO", "2": "FEMININO", "0": "IGNORADO", "9": "IGNORADO"}
RACE = {"1": "BRANCA", "2": "PRETA", "3": "AMARELA", "4": "PARDA", "5": "INDIGENA",
        "9": "IGNORADO"}
MARITAL_STATUS = {
    "1": "SOLTEIRA", "2": "CASADA", "3": "VIUVA", "4": "SEPARADA JUDICIALMENTE / DIVORCIADA",
    "5": "UNIAO ESTAVEL", "9": "IGNORADO",
}
PLACE_OF_DEATH = {
    "1": "HOSPITAL", "2": "OUTROS ESTABELECIMENTOS DE SAUDE", "3": "DOMICILIO",
    "4": "VIA PUBLICA", "5": "OUTROS", "6": "ALDEIA INDIGENA", "9": "IGNORADO",
}
CIRCUMSTANCE = {"1": "ACIDENTE", "2": "SUICIDIO", "3": "HOMICIDIO", "4": "OUTROS",
                "9": "IGNORADO"}
PREGNANCY = {"1": "SIM", "2": "NAO", "9": "IGNORADO"}
PUERPERIUM = {
    "1": "SIM, ATE 42 DIAS APOS O PARTO", "2": "SIM, DE 43 DIAS A 1 ANO APOS O PARTO",
    "3": "NAO", "9": "IGNORADO",
}

ICD_METHOD = {
    "X85": "Agressão por meio de drogas, medicamentos e substâncias biológicas",
    "X86": "Agressão por meio de substâncias corrosivas",
    "X87": "Agressão por pesticidas",
    "X88": "Agressão por meio de gases e vapores",
    "X89": "Agressão por meio de outros produtos químicos e substâncias nocivas especificados",
    "X90": "Agressão por meio de produtos químicos e substâncias nocivas não especificados",
    "X91": "Agressão por meio de enforcamento, estrangulamento e sufocação",
    "X92": "Agressão por meio de afogamento e submersão",
    "X93": "Agressão por meio de disparo de arma de fogo de mão",
    "X94": "Agressão por meio de disparo de espingarda, carabina ou arma de fogo de maior calibre",
    "X95": "Agressão por meio de disparo de outra arma de fogo ou de arma não especificada",
    "X96": "Agressão por meio de material explosivo",
    "X97": "Agressão por meio de fumaça, fogo e chamas",
    "X98": "Agressão por meio de vapor de água, gases ou objetos quentes",
    "X99": "Agressão por meio de objeto cortante ou penetrante",
    "Y00": "Agressão por meio de um objeto contundente",
    "Y01": "Agressão por meio de projeção de um lugar elevado",
    "Y02": "Agressão por meio de projeção ou colocação da vítima diante de um objeto em movimento",
    "Y03": "Agressão por meio de impacto de um veículo a motor",
    "Y04": "Agressão por meio de força corporal",
    "Y05": "Agressão sexual por meio de força física",
    "Y06": "Negligência e abandono",
    "Y07": "Outras síndromes de maus tratos",
    "Y08": "Agressão por outros meios especificados",
    "Y09": "Agressão por meios não especificados",
}
ICD_PLACE = {
    "0": "Residência",
    "1": "Habitação coletiva",
    "2": "Escolas, outras instituições e áreas de administração pública",
    "3": "Área para a prática de esportes e atletismo",
    "4": "Rua e estrada",
    "5": "Áreas de comércio e de serviços",
    "6": "Áreas industriais e em construção",
    "7": "Fazenda",
    "8": "Outros locais especificados",
    "9": "Local não especificado",
}
ICD_AGGRESSOR = {
    "0": "Esposo ou companheiro", "1": "Pais", "2": "Conhecido ou amigo",
    "3": "Autoridades oficiais", "8": "Outra pessoa especificada", "9": "Pessoa não especificada",
}
BY_AGGRESSOR = {
    "Y06": ["0", "1", "2", "8", "9"],
    "Y07": ["0", "1", "2", "3", "8", "9"],
}
"""Categories whose fourth character is the aggressor, with the valid characters."""


def assault_codes() -> list[str]:
    """Every category alone (many records omit the subdivision) and with each of
    its valid fourth characters."""
    return [category + tail for category in ICD_METHOD
            for tail in ["", *BY_AGGRESSOR.get(category, ICD_PLACE)]]
