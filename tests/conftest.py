from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import local_session  # noqa: E402
from rollcall.schema import BRONZE  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture
def people(spark):
    """Bronze rows from partial dictionaries; what is not given has a harmless default."""
    default = dict(
        matricula=1, nome_ficticio="Colaborador_1", area="RH", cargo="Cargo_1", senioridade="Júnior/Pleno",
        data_admissao="2020-01-15", tempo_casa_meses=12, idade=30, genero="Feminino", raca_cor="Parda",
        cidade="Recife", salario_mensal=5000.0, engajamento_score_base=7.0, performance_score=3.0,
        produtividade_index_base=90.0, gestor_matricula=None, status="Ativo", data_desligamento=None,
        tipo_desligamento=None, motivo_desligamento=None)

    def make(*rows: dict):
        filled = [default | row for row in rows]
        return spark.createDataFrame([tuple(r[c] for c in BRONZE.fieldNames()) for r in filled], BRONZE)

    return make


def rows(df, *columns):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
