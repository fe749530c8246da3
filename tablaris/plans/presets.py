"""Ready-made specifications for the three data sets the library was built around."""

from __future__ import annotations

from tablaris.operators.scoring import Exercise, Messages
from tablaris.spec import CleanSpec, Field, Labels, Rule

# FIXED VALUES: header aliases, validity limits, flag and report names, form
# labels and messages that existing inputs and consumers rely on.

DAY_LABELS = Labels(
    inserted="dia_insertado",
    imputed="imputado_",
    outlier="outlier_",
    raw_rows="filas_raw",
    typed_rows="filas_tipadas",
    invalid_rows="filas_invalidas_eliminadas",
    duplicates="duplicados_dia_eliminados",
    key_range="rango_dia",
    filled="dias_faltantes_rellenados",
    nulls_before="nulos_antes_imputacion",
    nulls_after="nulos_despues_imputacion",
    imputations="imputaciones_por_columna",
    outliers="outliers_iqr",
    detected="detectados",
    low_limit="limite_inferior",
    high_limit="limite_superior",
    final_rows="filas_finales",
)

ROW_LABELS = Labels(
    imputed="imputado_",
    outlier="outlier_",
    raw_rows="filas_raw",
    typed_rows="filas_tipadas",
    invalid_rows="filas_invalidas_eliminadas",
    duplicates="duplicados_exactos_eliminados",
    nulls_before="nulos_antes_imputacion",
    nulls_after="nulos_despues_imputacion",
    imputations="imputaciones_por_columna",
    outliers="outliers_iqr",
    detected="detectados",
    low_limit="limite_inferior",
    high_limit="limite_superior",
    final_rows="filas_finales",
)

DOLLAR = CleanSpec(
    fields=(
        Field("dia", "int", ("day",), decimal_comma=False),
        Field("inflacion", aliases=("inflation",)),
        Field("tasa_interes", aliases=("tasa_de_interes", "interest_rate")),
        Field("precio_dolar", aliases=("precio_del_dolar", "dollar_price")),
    ),
    rules=(Rule("dia", low=0, low_open=True),),
    key="dia",
    fill_gaps=True,
    impute=("inflacion", "tasa_interes", "precio_dolar"),
    order_by=("dia",),
    cap=("inflacion", "tasa_interes", "precio_dolar"),
    sort_by=("dia",),
    labels=DAY_LABELS,
)

ENERGY = CleanSpec(
    fields=(
        Field("temperatura", aliases=("temperature",)),
        Field("hora", "int", ("hour",)),
        Field("dia_semana", "int", ("dia_de_semana", "day_of_week")),
        Field("consumo_energia", aliases=("consumo_de_energia", "energy_consumption")),
    ),
    rules=(Rule("hora", 1, 24), Rule("dia_semana", 1, 7)),
    impute=("temperatura", "consumo_energia"),
    group_by=("dia_semana",),
    order_by=("hora",),
    cap=("temperatura", "consumo_energia"),
    labels=ROW_LABELS,
)

GLUCOSE = CleanSpec(
    fields=(
        Field("edad", "int", ("age",)),
        Field("imc", aliases=("bmi",)),
        Field("actividad_fisica", "int", ("actividadfisica", "physical_activity")),
        Field("nivel_glucosa", aliases=("glucose_level",)),
    ),
    rules=(
        Rule("edad", 0, 120),
        Rule("imc", 0, 80, low_open=True),
        Rule("actividad_fisica", 0, 24),
        Rule("nivel_glucosa", 20, 600),
    ),
    impute=("imc", "nivel_glucosa"),
    group_by=("actividad_fisica",),
    order_by=("edad",),
    cap=("imc", "nivel_glucosa"),
    sort_by=("edad", "actividad_fisica"),
    labels=ROW_LABELS,
)

SPECS = {"dolar": DOLLAR, "energia": ENERGY, "glucosa": GLUCOSE}

EXERCISES = (
    Exercise(
        "dolar",
        "Prediccion del precio del dolar",
        (("dia", "Dia"), ("inflacion", "Inflacion"), ("tasa_interes", "Tasa de interes")),
        "precio_dolar",
        "dolar",
        "Modelo",
    ),
    Exercise(
        "glucosa",
        "Prediccion del nivel de glucosa",
        (("edad", "Edad"), ("imc", "IMC"), ("actividad_fisica", "Actividad fisica")),
        "nivel_glucosa",
        "glucosa",
        "Modelo",
    ),
    Exercise(
        "energia",
        "Prediccion del consumo de energia electrica",
        (("temperatura", "Temperatura"), ("hora", "Hora"), ("dia_semana", "Dia de semana")),
        "consumo_energia",
        "energia",
        "Modelo",
    ),
)

MESSAGES = Messages(
    unknown="Debes seleccionar un ejercicio valido.",
    empty="El campo '{}' es obligatorio.",
    not_numeric="El campo '{}' debe ser numerico.",
    no_model="No se encontro el archivo del modelo: {}",
    unmapped="No se pudieron mapear variables del modelo: {}",
    failed="No se pudo realizar la prediccion: {}",
)
