"""Class, share, split and level labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentpanel.functions.clean import clean_text, col

# The five outcomes of the corridor check and the policy name.
MISSING_COORDS = "missing_or_invalid_coords"
DECLARED_INSIDE = "declared_and_inside"
DECLARED_OUTSIDE = "declared_outside"
UNDECLARED_INSIDE = "undeclared_inside"
OUTSIDE_ALL = "outside_all"
REVIEW_CLASSES = [DECLARED_OUTSIDE, UNDECLARED_INSIDE, MISSING_COORDS]
CANONICAL_POLICY = "strict_declared_and_inside"

# Cause of the event -> category.
CAUSE_CATEGORIES = {
    "conduta_ou_condicao_do_condutor": [
        "Condutor Dormindo",
        "Falta de Atenção à Condução",
        "Não guardar distância de segurança",
        "Velocidade Incompatível",
        "Ultrapassagem Indevida",
        "Ingestão de Álcool",
        "Desobediência às normas de trânsito pelo condutor",
        "Mal Súbito",
        "Ingestão de Substâncias Psicoativas",
        "Ingestão de álcool pelo condutor",
        "Ausência de reação do condutor",
        "Reação tardia ou ineficiente do condutor",
        "Manobra de mudança de faixa",
        "Transitar na contramão",
        "Condutor deixou de manter distância do veículo da frente",
        "Deixar de acionar o farol da motocicleta (ou similar)",
        "Transitar no Acostamento",
        "Suicídio (presumido)",
        "Transtornos Mentais (exceto suicidio)",
        "Mal súbito do condutor",
        "Acessar a via sem observar a presença dos outros veículos",
        "Trafegar com motocicleta (ou similar) entre as faixas",
        "Transitar no acostamento",
        "Estacionar ou parar em local proibido",
        "Desrespeitar a preferência no cruzamento",
        "Condutor desrespeitou a iluminação vermelha do semáforo",
        "Acesso irregular",
        "Ingestão de substâncias psicoativas pelo condutor",
        "Condutor usando celular",
        "Retorno proibido",
        "Transitar na calçada",
        "Participar de racha",
        "Conversão proibida",
        "Frear",
    ],
    "condicao_da_via": [
        "Defeito na Via",
        "Pista Escorregadia",
        "Objeto estático sobre o leito carroçável",
        "Sinalização da via insuficiente ou inadequada",
        "Restrição de Visibilidade",
        "Curva acentuada",
        "Obras na pista",
        "Demais falhas na via",
        "Área urbana sem a presença de local apropriado para a travessia de pedestres",
        "Desvio temporário",
        "Sinalização mal posicionada",
        "Declive acentuado",
        "Falta de elemento de contenção que evite a saída do leito carroçável",
        "Restrição de visibilidade em curvas verticais",
        "Acumulo de água sobre o pavimento",
        "Acostamento em desnível",
        "Ausência de sinalização",
        "Obstrução na via",
        "Iluminação deficiente",
        "Acumulo de areia ou detritos sobre o pavimento",
        "Falta de acostamento",
        "Semáforo com defeito",
        "Deficiência do Sistema de Iluminação/Sinalização",
        "Acumulo de óleo sobre o pavimento",
        "Pista em desnível",
        "Pista esburacada",
        "Faixas de trânsito com largura insuficiente",
        "Afundamento ou ondulação no pavimento",
        "Sistema de drenagem ineficiente",
        "Sinalização encoberta",
        "Restrição de visibilidade em curvas horizontais",
        "Redutor de velocidade em desacordo",
    ],
    "condicao_do_veiculo": [
        "Defeito Mecânico no Veículo",
        "Avarias e/ou desgaste excessivo no pneu",
        "Demais falhas mecânicas ou elétricas",
        "Carga excessiva e/ou mal acondicionada",
        "Modificação proibida",
        "Problema na suspensão",
        "Deficiência ou não Acionamento do Sistema de Iluminação/Sinalização do Veículo",
        "Faróis desregulados",
        "Problema com o freio",
    ],
    "condicao_ou_conduta_do_pedestre_ou_agentes_fora_da_pista": [
        "Desobediência às normas de trânsito pelo pedestre",
        "Falta de Atenção do Pedestre",
        "Ingestão de álcool e/ou substâncias psicoativas pelo pedestre",
        "Pedestre cruzava a pista fora da faixa",
        "Pedestre andava na pista",
        "Entrada inopinada do pedestre",
        "Pedestre - Ingestão de álcool/ substâncias psicoativas",
        "Agressão Externa",
        "Obstrução Via tentativa Assalto",
        "Ingestão de álcool ou de substâncias psicoativas pelo pedestre",
    ],
    "condicao_ou_fenomeno_da_natureza": [
        "Fumaça",
        "Neblina",
        "Demais Fenômenos da natureza",
        "Fenômenos da Natureza",
        "Animais na Pista",
        "Chuva",
    ],
}


def incident_class(valid: Column | str, declared: Column | str, inside: Column | str) -> Column:
    v, d, i = (F.coalesce(col(c), F.lit(False)) for c in (valid, declared, inside))
    return (
        F.when(~v, MISSING_COORDS)
        .when(d & i, DECLARED_INSIDE)
        .when(d, DECLARED_OUTSIDE)
        .when(i, UNDECLARED_INSIDE)
        .otherwise(OUTSIDE_ALL)
    )


def with_review_flags(df: DataFrame, class_col: str = "incident_class") -> DataFrame:
    return df.withColumns(
        {
            "review_candidate": F.col(class_col).isin(REVIEW_CLASSES),
            "canonical_policy": F.lit(CANONICAL_POLICY),
            "is_canonical": F.col(class_col) == DECLARED_INSIDE,
        }
    )


def safe_share(part: Column | str, whole: Column | str) -> Column:
    """Ratio, null when the denominator is not positive."""
    return F.when(col(whole) > 0, col(part).cast("double") / col(whole))


def observed(count: Column | str) -> Column:
    return F.coalesce(col(count), F.lit(0)) > 0


def cause_lookup(spark: SparkSession) -> DataFrame:
    """The cause table as rows; its size is fixed (under a hundred rows)."""
    rows = [(cause, category) for category, causes in CAUSE_CATEGORIES.items() for cause in causes]
    return spark.createDataFrame(rows, "cause string, cause_category string")


def with_cause_category(df: DataFrame, cause_col: str, lookup: DataFrame | None = None) -> DataFrame:
    table = lookup if lookup is not None else F.broadcast(cause_lookup(df.sparkSession))
    table = table.withColumnRenamed("cause", cause_col)
    return df.join(table, cause_col, "left").withColumn("cause_category", F.coalesce("cause_category", F.lit("unknown")))


def split_by_range(day: Column | str, ranges: Mapping[str, tuple[date, date]], default: str = "outside_scope") -> Column:
    label = F.lit(default)
    for name, (lo, hi) in reversed(list(ranges.items())):
        label = F.when(col(day).between(F.lit(lo), F.lit(hi)), name).otherwise(label)
    return label


def split_by_year(year: Column | str, years: Mapping[str, tuple[int, int]], default: str = "out_of_range") -> Column:
    label = F.lit(default)
    for name, (lo, hi) in reversed(list(years.items())):
        label = F.when(col(year).between(lo, hi), name).otherwise(label)
    return label


def level_label(value: Column | str, two_digits: bool = False) -> Column:
    """Category level as text: null -> missing, months as two digits."""
    text = col(value).cast("string")
    if two_digits:
        number = text.try_cast("double").try_cast("int")
        text = F.coalesce(F.lpad(number.cast("string"), 2, "0"), text)
    return F.coalesce(text, F.lit("missing"))


def rule_condition(df: DataFrame, conditions: Sequence[tuple[str, Sequence[object]]]) -> Column:
    """All conditions of one exclusion rule; text matches trimmed and upper-cased."""
    matched = F.lit(True)
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    types = dict(df.dtypes)
    for name, values in conditions:
        if name not in types:
            raise KeyError(f"exclusion column {name!r} is not in the frame")
        if types[name] in numeric or types[name].startswith("decimal"):
            numbers = []
            for value in values:
                try:
                    numbers.append(float(value))
                except (TypeError, ValueError):
                    continue
            hit = F.col(name).cast("double").isin(numbers) if numbers else F.lit(False)
        else:
            texts = [str(value).strip().upper() for value in values]
            hit = F.coalesce(clean_text(name, upper=True), F.lit("")).isin(texts)
        matched = matched & F.coalesce(hit, F.lit(False))
    return matched
