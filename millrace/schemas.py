"""Declared schemas of both fact domains.  No reader infers a schema.

Column names, widths and log layouts are fixed values: results are compared by name.
"""

from __future__ import annotations

from pyspark.sql import types as T

from millrace.operators.bounds import part_of

INT, LONG, TEXT = T.IntegerType(), T.LongType(), T.StringType()
DAY, MOMENT, MONEY = T.DateType(), T.TimestampType(), T.DecimalType(12, 2)
FLAG = T.BooleanType()


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def by_month(schema: T.StructType, date: str) -> T.StructType:
    """``schema`` with its columns ``Anio`` and ``Mes`` declared as parts of ``date``."""
    parts = {"Anio": "year", "Mes": "month"}
    return T.StructType(
        [part_of(f.name, f.dataType, date, parts[f.name]) if f.name in parts else f for f in schema.fields]
    )


# Flat attentions record, in file order.  Grain: day x facility x service x sex x age x
# ethnicity x insurance.
ATTENTIONS = record(
    ANIO=INT, MES=INT, DIA=INT, CATEGORIA=TEXT, RED=TEXT, MICRORED=TEXT, CODIGO_UNICO=INT,
    NOMBRE_ESTACLECIMIENTO=TEXT, PROVINCIA=TEXT, DISTRITO=TEXT, EDAD_REG=INT, TIPO_EDAD=TEXT,
    SEXO=TEXT, ETNIA=TEXT, TIPO_SEGURO=TEXT, UPS=TEXT, ATENDIDOS=INT, ATENCIONES=INT,
    FECHA_CORTE=TEXT,
)

# The same record with its coercible numbers left as text, for jobs that repair bad values.
ATTENTIONS_TEXT = T.StructType(
    [
        T.StructField(f.name, T.StringType())
        if f.name in ("EDAD_REG", "ATENDIDOS", "ATENCIONES")
        else f
        for f in ATTENTIONS.fields
    ]
)

# Flat reimbursements record: all text until load.
REIMBURSEMENTS = record(
    Periodo=TEXT, Region=TEXT, Sede=TEXT, TipoDeAtencion=TEXT, MedioDeSolicitud=TEXT,
    Solicitante=TEXT, CondicionDelAsegurado=TEXT, Parentesco=TEXT, Situacion=TEXT,
    NumeroDeAsegurados=TEXT, SolicitudesDeReembolso=TEXT, MontoPagado=TEXT,
)

ATTENTION_FACT = by_month(record(
    AtencionId=LONG, Fecha=DAY, CodigoUnico=INT, UpsId=INT, EtniaId=INT, TipoSeguroId=INT,
    Sexo=TEXT, EdadReg=INT, TipoEdad=TEXT, Atendidos=INT, Atenciones=INT, FechaCorte=DAY,
    Anio=INT, Mes=INT,
), "Fecha")

REIMBURSEMENT_FACT = by_month(record(
    ReembolsoId=LONG, Periodo=DAY, SedeId=INT, TipoAtencionId=INT, MedioSolicitudId=INT,
    TipoSolicitanteId=INT, CondicionAseguradoId=INT, ParentescoId=INT, SituacionAseguradoId=INT,
    NumeroAsegurados=INT, SolicitudesReembolso=INT, MontoPagado=MONEY, Anio=INT, Mes=INT,
), "Periodo")

FACILITY = record(
    CodigoUnico=INT, Nombre=TEXT, CategoriaId=INT, MicroredId=INT, DistritoId=INT,
)

RUN_LOG = record(
    LogId=LONG, Proceso=TEXT, FechaInicio=MOMENT, FechaFin=MOMENT, FilasLeidas=LONG, FilasInsertadas=LONG,
    FilasRechazadas=LONG, Estado=TEXT, MensajeError=TEXT, UsuarioEjecucion=TEXT,
)

REJECT_LOG = record(
    ErrorId=LONG, Proceso=TEXT, StgId=LONG, Campo=TEXT, ValorOriginal=TEXT, Motivo=TEXT, FechaRegistro=MOMENT,
)

ATTENTION_AUDIT = record(
    AuditId=LONG, Operacion=TEXT, AtencionId=LONG, CodigoUnico=INT, Fecha=DAY, Atendidos_Anterior=INT,
    Atendidos_Nuevo=INT, Atenciones_Anterior=INT, Atenciones_Nuevo=INT, UsuarioBD=TEXT, FechaHora=MOMENT,
)

REIMBURSEMENT_AUDIT = record(
    AuditId=LONG, Operacion=TEXT, ReembolsoId=LONG, Periodo=DAY, MontoPagado_Anterior=MONEY,
    MontoPagado_Nuevo=MONEY, UsuarioBD=TEXT, FechaHora=MOMENT,
)

MICRO_BATCH = record(
    Flujo=TEXT, Lote=LONG, Desde=LONG, Hasta=LONG, Estado=TEXT,
)

STEP_LOG = record(
    Etapa=TEXT, FilasEntrada=LONG, FilasSalida=LONG, Detalle=TEXT,
)

CLOSED_PERIODS = record(
    Anio=INT, Mes=INT, FechaCierre=DAY,
)

DOCUMENT = record(
    fecha=DAY,
    establecimiento=record(
        codigo=LONG, nombre=TEXT, categoria=TEXT, red=TEXT, microred=TEXT, provincia=TEXT,
        distrito=TEXT,
    ),
    paciente=record(edad=INT, tipoEdad=TEXT, sexo=TEXT, etnia=TEXT, seguro=TEXT),
    ups=TEXT,
    atendidos=LONG,
    atenciones=LONG,
    fechaCorte=TEXT,
)

# Text widths of the flat attentions staging table.
ATTENTION_WIDTHS = {
    "CATEGORIA": 10,
    "RED": 100,
    "MICRORED": 150,
    "NOMBRE_ESTACLECIMIENTO": 150,
    "PROVINCIA": 50,
    "DISTRITO": 50,
    "TIPO_EDAD": 10,
    "SEXO": 10,
    "ETNIA": 50,
    "TIPO_SEGURO": 20,
    "UPS": 150,
    "FECHA_CORTE": 8,
}

AGE_UNIT = record(TipoEdad=TEXT, Descripcion=TEXT)

# Fixed catalogue of age units.
AGE_UNITS = [("A", "Años"), ("M", "Meses"), ("D", "Días")]
