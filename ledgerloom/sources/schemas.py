"""Column lists of the source files, and the schemas of our own tables."""

from pyspark.sql import types as T

REGISTRY = {
    "empresa": ("*EMPRECSV*", "cnpj_basico razao_social natureza_juridica qualificacao_responsavel capital_social porte_empresa ente_federativo"),
    "estabelecimento": (
        "*ESTABELE*",
        "cnpj_basico cnpj_ordem cnpj_dv identificador_matriz_filial nome_fantasia situacao_cadastral data_situacao_cadastral motivo_situacao_cadastral "
        "nome_cidade_exterior codigo_pais data_inicio_atividade cnae_principal cnaes_secundarios tipo_logradouro logradouro numero complemento bairro cep uf "
        "codigo_municipio ddd1 telefone1 ddd2 telefone2 ddd_fax fax correio_eletronico situacao_especial data_situacao_especial",
    ),
    "socio": (
        "*SOCIOCSV*",
        "cnpj_basico identificador_socio nome_socio cnpj_cpf_socio qualificacao_socio data_entrada_sociedade codigo_pais representante_legal "
        "nome_representante qualificacao_representante faixa_etaria",
    ),
    "simples": ("*SIMPLES*", "cnpj_basico opcao_simples data_opcao_simples data_exclusao_simples opcao_mei data_opcao_mei data_exclusao_mei"),
    "cnae": ("*CNAECSV*", "codigo descricao"),
    "motivo": ("*MOTICSV*", "codigo descricao"),
    "municipio": ("*MUNICCSV*", "codigo descricao"),
    "natureza": ("*NATJUCSV*", "codigo descricao"),
    "pais": ("*PAISCSV*", "codigo descricao"),
    "qualificacao": ("*QUALSCSV*", "codigo descricao"),
}
PARTITIONED = ("empresa", "estabelecimento", "socio", "simples")
WORKS = (
    "cno codigo_pais nome_pais data_inicio data_inicio_responsabilidade data_registro cno_vinculado cep ni_responsavel qualificacao_responsavel nome "
    "codigo_municipio nome_municipio tipo_logradouro logradouro numero_logradouro bairro estado caixa_postal complemento unidade_medida area_total situacao "
    "data_situacao nome_empresarial codigo_localizacao"
)
LINKS = "cno data_inicio data_fim data_registro qualificacao_contribuinte ni_responsavel"
CARRIERS = (
    "nome_transportador numero_rntrc data_primeiro_cadastro situacao_rntrc cpfcnpjtransportador categoria_transportador cep municipio uf equiparado "
    "data_situacao_rntrc"
)
MODULE = "cnpj cnpj_prefix payload_json content_hash source_updated_at module_updated_at"


def strings(names: str) -> T.StructType:
    """A schema of nullable strings."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


def registry_schema(table: str) -> T.StructType:
    return strings(REGISTRY[table][1])


MODULE_SCHEMA = strings(MODULE)
STATE_SCHEMA = "module string, cnpj string, content_hash string"
STATE_INFO_SCHEMA = "module string, source_version string, schema_version string, updated_at string, location string"
_DATASET = (
    "struct<storage_release_id:string,json_property_name:string,schema_version:string,source_version:string,updated_at:string,record_count:bigint,"
    "zip_available:boolean,zip_size:bigint,zip_url:string,zip_md5checksum:string>"
)
MANIFEST_SCHEMA = f"total bigint, shard_count int, last_updated string, storage_release_id string, datasets map<string,{_DATASET}>"
CATALOG_SCHEMA = "success boolean, result struct<resources:array<struct<name:string,format:string,url:string,last_modified:string,position:string,size:string>>>"
