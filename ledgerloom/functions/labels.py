"""Code lists of the registry and of its side datasets."""

STATUS = {"01": "Nula", "02": "Ativa", "03": "Suspensa", "04": "Inapta", "08": "Baixada"}
BRANCH = {"1": "Matriz", "2": "Filial"}
COMPANY_SIZE = {"00": "Não informado", "01": "Microempresa (ME)", "03": "Empresa de Pequeno Porte (EPP)", "05": "Demais"}
PARTNER_TYPE = {"1": "Pessoa Jurídica", "2": "Pessoa Física", "3": "Estrangeiro"}
AGE_BAND = {
    "0": "Não se aplica",
    "1": "0 a 12 anos",
    "2": "13 a 20 anos",
    "3": "21 a 30 anos",
    "4": "31 a 40 anos",
    "5": "41 a 50 anos",
    "6": "51 a 60 anos",
    "7": "61 a 70 anos",
    "8": "71 a 80 anos",
    "9": "Mais de 80 anos",
}
WORK_STATUS = {"01": "NULA", "02": "ATIVA", "03": "SUSPENSA", "14": "PARALISADA", "15": "ENCERRADA"}
WORK_ROLE = {
    "0053": "Pessoa Jurídica Construtora",
    "0057": "Dono da Obra",
    "0064": "Incorporador de Construção Civil",
    "0070": "Proprietário do Imóvel",
    "0109": "Consórcio",
    "0110": "Construção em nome coletivo",
    "0111": "Sociedade Líder de Consórcio",
}
TRUE_WORDS = ("sim", "s", "true", "1")
