import pytest

from keyfold.spec import EntitySpec, Layout, Registry


def _spec(**kw):
    return EntitySpec("finance", "accounting", "fact", "erp", "general_ledger", "delta", "GL_4", env="qlt", **kw)


def test_layer_names():
    s = _spec()
    assert s.raw_path == "lake/qlt/raw/finance/accounting/erp/general_ledger/GL_4/delta"
    assert s.bronze_name == "qlt_bronze_finance.accounting_erp_general_ledger_GL_4"
    assert s.silver_name == "qlt_silver_finance.accounting_general_ledger_GL_4"
    own = _spec(layout=Layout(silver="{entity}_{env}"))
    assert own.silver_name == "general_ledger_qlt" and own.raw_path == s.raw_path


def test_mandatory_names_and_registry():
    with pytest.raises(ValueError):
        EntitySpec("finance", "", "fact", "erp", "gl", "delta", "x")
    reg = Registry()
    s = reg.add(_spec(primary_keys=("BUKRS", "FISCPER")))
    assert reg.get_spec("finance", "accounting", "general_ledger", "GL_4") is s
    assert reg.with_args(("finance", "accounting", "general_ledger", "GL_4"), sequence_column="SEQ").sequence_column == "SEQ"
