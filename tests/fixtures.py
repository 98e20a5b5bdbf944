"""A tiny instance of the reference's relational schema (FIXTURES.md §4)."""

from sheetrecon.plans.standin import values_table


def catalog(spark):
    def t(rows, ddl):
        if not rows:
            return spark.createDataFrame([], ddl)
        return spark.createDataFrame(rows, ddl)

    return {
        # proposals: 10153 (many parties), 116090 (two holders, same name),
        # 500 (no payment method, null amount), 600 (amount 0, missing dimension)
        "propuesta": t([(1, "10153", 1), (2, "116090", 1), (3, "500", 1), (4, "600", 1),
                        (5, "777", 1)],
                       "cod_propuesta long, legajo string, cod_tipo_propuesta int"),
        "contratos": t([(11, 1, "2024-01-05", 1, 1, 7, 1), (12, 2, "2024-02-01", 1, 1, 7, None),
                        (13, 3, "2023-12-31", 1, 1, 7, 1), (14, 4, "2024-03-03", 1, 99, 7, 1),
                        (15, 5, "2024-04-04", 1, 1, 7, 1)],
                       "cod_contrato long, cod_propuesta long, fecha string, cod_estado_contrato int, "
                       "cod_tipo_contrato int, cod_vendedor int, cod_plan_venta_modelo int"),
        "creditos": t([(1, 1500.50, 1, 1), (2, 99.99, 1, 1), (3, None, 2, 1), (4, 0.0, 2, 1),
                       (5, 10.0, 1, 1)],
                      "cod_propuesta long, monto double, cod_sucursal int, cod_estado_deuda int"),
        "sucursales": t([(1, "CENTRO"), (2, "NORTE")], "cod_sucursal int, nombre string"),
        "contratos_clientes": t([(100, 11, 2), (101, 11, 1), (102, 11, 3), (103, 11, 4),
                                 (104, 11, 1), (105, 12, 1), (106, 12, 1), (107, 13, 3),
                                 (108, 14, 1), (109, 15, 4)],
                                "cod_cliente long, cod_contrato long, cod_caracter_titular int"),
        "clientes": t([(100, "ZOE", "1", "2", None, "DNI", "1", "C1"),
                       (101, "MARTA", "1", "2", None, "DNI", "2", "C2"),
                       (102, "ANA", "1", "2", None, "DNI", "3", "C3"),
                       (103, "BETO", "1", "2", None, "DNI", "4", "C4"),
                       (104, "CARLA", "1", "2", None, "DNI", "5", "C5"),
                       (105, "PEDRO", "1", "2", None, "DNI", "6", "C6"),
                       (106, "PEDRO", "9", "9", None, "DNI", "7", "C7"),
                       (107, None, "1", "2", None, "DNI", "8", "C8"),
                       (108, "LUIS", "1", "2", None, "DNI", "9", "C9"),
                       (109, "EVA", "1", "2", None, "DNI", "10", "C10")],
                      "cod_cliente long, nombre string, telefono string, telefono_movil string, "
                      "telefono_laboral string, tipo_documento string, nro_documento string, cuit string"),
        # roles: 1 TITULAR, 2 Titular (case), 3 PROPIETARIO, 4 other
        "caracter_titulares": values_table(spark, [(1, "TITULAR"), (2, "Titular"), (3, "PROPIETARIO"),
                                                   (4, "AVAL")], "cod_caracter_titular int, nombre string")
        .selectExpr("cast(cod_caracter_titular as int) cod_caracter_titular", "nombre"),
        "estados_deudas": t([(1, "VIGENTE")], "cod_estado_deuda int, estado string"),
        "estados_contratos": t([(1, "ACTIVO")], "cod_estado_contrato int, estado string"),
        "tipos_propuestas": t([(1,)], "cod_tipo_propuesta int"),
        "tipos_contratos": t([(1, "CONTADO")], "cod_tipo_contrato int, nombre string"),
        "vendedor": t([(7, "VENDEDOR 7", 1)], "cod_vendedor int, nombre string, cod_equipo int"),
        "equipo_vendedores": t([(1, "EQUIPO A")], "cod_equipo int, descripcion string"),
        "planes_ventas_modelos": t([(1, "PLAN 1")], "cod_plan_venta_modelo int, nombre string"),
        "contratos_parcelas": t([(11, 1)], "cod_contrato_parcela long, cod_parcela int"),
        "parcela": t([(1, "P-1", 1, 1)], "cod_parcela int, legajo string, cod_estado int, cod_manzana int"),
        "estados_parcela": t([(1,)], "cod_estado_parcela int"),
        "manzana": t([(1, 1)], "cod_manzana int, cod_zona_parque int"),
        "zonas_parques": t([(1,)], "cod_zona_parque int"),
        # client 101 has two payment methods; 108 none
        "medios_cobros": t([(1, 101, "EFECTIVO", 5, 1), (2, 101, "BANCO", 5, 1), (3, 105, "BANCO", 6, 1),
                            (4, 102, "EFECTIVO", 6, 1)],
                           "cod_medio_cobro int, cod_cliente long, descripcion string, "
                           "cod_cobrador_asignado int, cod_zona_cobranza int"),
        "zona_cobranza": t([(1, 9, "ZONA 1")], "cod_zona_cobranza int, cod_modalidad_cobranza int, descripcion string"),
        "medios_cobros_domicilios": t([(1, 10), (2, 10), (2, 11), (3, 12)], "cod_medio_cobro int, cod_domicilio int"),
        "domicilios": t([(10, "CALLE 1", "M1", 1, 1), (11, "CALLE 2", "M2", 1, 1), (12, "CALLE 3", "M3", 1, 1)],
                        "cod_domicilio int, direccion string, manzana string, cod_barrio int, cod_localidad int"),
        "barrios": t([(1, "BARRIO")], "cod_barrio int, nombre string"),
        "localidades": t([(1, "CIUDAD", 1)], "cod_localidad int, nombre string, cod_provincia int"),
        "provincias": t([(1, "PROVINCIA")], "cod_provincia int, nombre string"),
        "tarjeta_oxxo": t([(1, 5, "OX1")], "cod_propuesta long, cod_usuario_alta int, codigo_barra string"),
        "clabe_bancaria": t([(1, 12345678901234), (2, None)], "cod_propuesta long, clabe long"),
        "medios_cobros_bancos": t([(2, "CTA-2", "MARTA"), (3, "CTA-3", None)],
                                  "cod_medio_cobro int, nro_cuenta string, titular string"),
    }


def write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path
